"""Column tests and lineage questions over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.operators import cursors, lineage, quality
from quarrymill.plans import tables
from quarrymill.plans.registry import query
from quarrymill.plans.tables import load, with_raw
from quarrymill.sinks.store import scratch_store

# --- column tests -----------------------------------------------------------------------------


def _failures_sql(model: str, source: str, tests: dict[str, list[str]]) -> str:
    parts = []
    for column, names in tests.items():
        for name in names:
            count = (
                f"select count(*) from {source} where {column} is null"
                if name == "not_null"
                else f"select count(*) from (select {column} from {source} where {column} is not null "
                f"group by 1 having count(*) > 1)"
            )
            parts.append(
                f"select '{model}' as model, '{column}' as \"column\", '{name}' as test, ({count}) as failures"
            )
    return " union all ".join(parts)


_CUSTOMER_NULLS = {"id": ["not_null"], "email": ["not_null"], "name": ["not_null"]}
_LINE_KEYS = {"l_orderkey": ["unique"], "l_suppkey": ["unique"], "l_extendedprice": ["unique"], "l_shipdate": ["unique"]}
_ORDER_TESTS = {
    "o_orderkey": ["unique", "not_null"],
    "o_custkey": ["unique", "not_null"],
    "o_orderstatus": ["unique"],
}
_EVENT_TESTS = {"event_id": ["unique", "not_null"], "ts": ["unique"], "user_id": ["unique", "not_null"]}


@query(
    "test_not_null",
    f"""{with_raw("raw_stripe_customers")}
    select "column", test, failures from ({_failures_sql("m", "raw_stripe_customers", _CUSTOMER_NULLS)})""",
)
def test_not_null(spark, sf_dir):
    return quality.column_test_counts(tables.raw_stripe_customers(spark, sf_dir), _CUSTOMER_NULLS)


@query(
    "test_unique",
    f'select "column", test, failures from ({_failures_sql("m", "lineitem", _LINE_KEYS)})',
)
def test_unique(spark, sf_dir):
    """Four columns in one scan and one shuffle, each in its own type."""
    return quality.column_test_counts(load(spark, sf_dir, "lineitem"), _LINE_KEYS)


test_not_null.__test__ = test_unique.__test__ = False


@query(
    "run_column_tests",
    f"""with t as ({_failures_sql("orders", "orders", _ORDER_TESTS)}
         union all {_failures_sql("events", "events", _EVENT_TESTS)})
    select model, "column", test, case when failures = 0 then 'pass' else 'fail' end as status, failures from t
    union all select 'events', 'missing', 'unique', 'error', null""",
)
def run_column_tests(spark, sf_dir):
    """A test on a column that does not exist is an error; the others still run."""
    results = quality.run_column_tests(
        spark,
        [
            quality.TestedModel("orders", load(spark, sf_dir, "orders"), _ORDER_TESTS),
            quality.TestedModel("events", load(spark, sf_dir, "events"), _EVENT_TESTS | {"missing": ["unique"]}),
        ],
    )
    return results.select("model", "column", "test", "status", "failures")


@query(
    "source_column_tests",
    f"""{with_raw("raw_stripe_charges")}, t as ({_failures_sql("raw_stripe_charges", "raw_stripe_charges",
        {"id": ["unique", "not_null"], "customer": ["not_null"]})})
    select model, "column", test, case when failures = 0 then 'pass' else 'fail' end as status, failures from t""",
)
def source_column_tests(spark, sf_dir):
    """Tests declared on a stream, run on its raw table. Charge ids repeat in this data."""
    store = scratch_store(spark, "source_tests")
    declared = cursors.StreamConfig(column_tests={"id": ["unique", "not_null"], "customer": ["not_null"]})
    charges = tables.raw_stripe_charges(spark, sf_dir)
    cursors.load_stream(store, "stripe", "charges", lambda mark: charges, declared)
    results = cursors.run_source_tests(store, "stripe", {"charges": declared})
    return results.select("model", "column", "test", "status", "failures")


@query(
    "duplicate_ids",
    "select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1",
)
def duplicate_ids(spark, sf_dir):
    return quality.duplicate_ids(load(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


# --- lineage ----------------------------------------------------------------------------------

# region -> nation -> customer -> order -> supplier of a line, as upstream -> downstream
_EDGES_SQL = """
edges as (
    select 'region:' || n_regionkey as upstream, 'nation:' || n_nationkey as downstream from nation
    union all select 'nation:' || c_nationkey, 'customer:' || c_custkey from customer
    union all select 'customer:' || o_custkey, 'order:' || o_orderkey from orders
    union all select 'order:' || l_orderkey, 'supplier:' || l_suppkey from lineitem)"""


def _node(kind: str, key: str):
    return F.concat(F.lit(f"{kind}:"), F.col(key).cast("string"))


def edges(spark, sf_dir) -> DataFrame:
    steps = [
        ("nation", "region", "n_regionkey", "nation", "n_nationkey"),
        ("customer", "nation", "c_nationkey", "customer", "c_custkey"),
        ("orders", "customer", "o_custkey", "order", "o_orderkey"),
        ("lineitem", "order", "l_orderkey", "supplier", "l_suppkey"),
    ]
    parts = [
        load(spark, sf_dir, table).select(
            _node(up, up_key).alias("upstream"), _node(down, down_key).alias("downstream")
        )
        for table, up, up_key, down, down_key in steps
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "graph_descendants",
    f"""with recursive {_EDGES_SQL},
    reach as (select 'region:' || r_regionkey as id from region where r_name = 'ASIA'
              union select e.downstream from reach r join edges e on e.upstream = r.id)
    select id from reach""",
)
def graph_descendants(spark, sf_dir):
    asia = load(spark, sf_dir, "region").filter("r_name = 'ASIA'").select(_node("region", "r_regionkey").alias("id"))
    return lineage.graph_descendants(edges(spark, sf_dir), asia)


@query(
    "graph_ancestors",
    f"""with recursive {_EDGES_SQL},
    reach as (select 'order:' || o_orderkey as id from orders where o_orderpriority = '1-URGENT'
              union select e.upstream from reach r join edges e on e.downstream = r.id)
    select id from reach""",
)
def graph_ancestors(spark, sf_dir):
    urgent = load(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'")
    return lineage.graph_ancestors(edges(spark, sf_dir), urgent.select(_node("order", "o_orderkey").alias("id")))


_LATE = 250


def chained_orders(spark, sf_dir) -> DataFrame:
    """Every order leads to the one with the next key, and to the suppliers of its lines: as deep as there are orders."""
    orders = load(spark, sf_dir, "orders")
    follows = orders.select(
        _node("order", "o_orderkey").alias("upstream"),
        F.concat(F.lit("order:"), (F.col("o_orderkey") + 1).cast("string")).alias("downstream"),
    )
    lines = load(spark, sf_dir, "lineitem").select(
        _node("order", "l_orderkey").alias("upstream"), _node("supplier", "l_suppkey").alias("downstream")
    )
    return follows.unionByName(lines)


@query(
    "graph_chain_descendants",
    f"""select 'order:' || o_orderkey as id from orders where o_orderkey >= {_LATE}
    union select 'order:' || (max(o_orderkey) + 1) from orders
    union select 'supplier:' || l_suppkey from lineitem where l_orderkey >= {_LATE}""",
)
def graph_chain_descendants(spark, sf_dir):
    """A search as deep as the table is long, in rounds that grow with its logarithm."""
    start = load(spark, sf_dir, "orders").filter(F.col("o_orderkey") == _LATE)
    return lineage.graph_descendants(chained_orders(spark, sf_dir), start.select(_node("order", "o_orderkey").alias("id")))


@query(
    "graph_chain_ancestors",
    """select 'order:' || o_orderkey as id from orders
    where o_orderkey <= (select max(l_orderkey) from lineitem where l_suppkey = 7)
    union select 'supplier:7'""",
)
def graph_chain_ancestors(spark, sf_dir):
    start = load(spark, sf_dir, "supplier").filter("s_suppkey = 7")
    return lineage.graph_ancestors(chained_orders(spark, sf_dir), start.select(_node("supplier", "s_suppkey").alias("id")))


@query(
    "select_many",
    """with down as (
        select c_custkey % 64 as selection, 'customer:' || c_custkey as id from customer
        union select o_custkey % 64, 'order:' || o_orderkey from orders where o_custkey in (select c_custkey from customer)
        union select o_custkey % 64, 'supplier:' || l_suppkey from lineitem join orders on l_orderkey = o_orderkey
              where o_custkey in (select c_custkey from customer)),
    up as (
        select c_custkey % 64 as selection, 'customer:' || c_custkey as id from customer
        union select c_custkey % 64, 'nation:' || c_nationkey from customer
        union select c_custkey % 64, 'region:' || n_regionkey from customer join nation on n_nationkey = c_nationkey)
    select cast(selection as int) as selection, id, 'downstream' as direction from down
    union all select cast(selection as int), id, 'upstream' from up""",
)
def select_many(spark, sf_dir):
    """64 selections of customers, each with all it depends on and all that depends on it, by one search per direction."""
    starts = load(spark, sf_dir, "customer").select((F.col("c_custkey") % 64).alias("selection"), _node("customer", "c_custkey").alias("id"))
    scratch = lineage.Scratch(spark)
    graph, _, _ = scratch.write(edges(spark, sf_dir))
    down = lineage.reach_many(graph, starts, edges_are_stored=True).withColumn("direction", F.lit("downstream"))
    up = lineage.reach_many(graph, starts, upstream=True, edges_are_stored=True).withColumn("direction", F.lit("upstream"))
    scratch.keep_only([])
    return down.unionByName(up)


def nodes(spark, sf_dir) -> DataFrame:
    """Parts as models: words of the name as tags, brand and type as the path."""
    return load(spark, sf_dir, "part").select(
        _node("part", "p_partkey").alias("id"),
        F.concat_ws("/", F.lit("models"), F.lower("p_type"), F.lower("p_brand")).alias("path"),
        F.when(F.col("p_size") > 25, "table").otherwise("view").alias("materialized"),
        F.split("p_name", " ").alias("tags"),
    )


_NODES_SQL = """with nodes as (
    select 'part:' || p_partkey as id, 'models/' || lower(p_type) || '/' || lower(p_brand) as path,
           case when p_size > 25 then 'table' else 'view' end as materialized, string_split(p_name, ' ') as tags
    from part) select id from nodes where """


@query("select_by_tag", _NODES_SQL + "list_contains(tags, 'ring')")
def select_by_tag(spark, sf_dir):
    return lineage.select_nodes(nodes(spark, sf_dir), "tag", "ring")


@query("select_by_path", _NODES_SQL + "contains(path, 'economy/')")
def select_by_path(spark, sf_dir):
    return lineage.select_nodes(nodes(spark, sf_dir), "path", "economy/")


@query("select_by_attr", _NODES_SQL + "materialized = 'table'")
def select_by_attr(spark, sf_dir):
    return lineage.select_nodes(nodes(spark, sf_dir), "config.materialized", "table")


@query("select_by_id", _NODES_SQL + "id = 'part:7'")
def select_by_id(spark, sf_dir):
    """A method nobody knows falls back to the id."""
    return lineage.select_nodes(nodes(spark, sf_dir), "name", "part:7")


@query(
    "dangling_refs",
    """select distinct 'cus_' || l_partkey as upstream, 'order:' || l_orderkey as downstream
    from lineitem where l_partkey not in (select c_custkey from customer)""",
)
def dangling_refs(spark, sf_dir):
    """Charges that name a customer who does not exist."""
    charges = load(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("cus_"), F.col("l_partkey").cast("string")).alias("upstream"),
        _node("order", "l_orderkey").alias("downstream"),
    )
    return lineage.dangling_refs(charges, tables.raw_stripe_customers(spark, sf_dir))
