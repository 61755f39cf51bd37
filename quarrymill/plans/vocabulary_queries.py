"""The relational vocabulary the models use, one query per operator, over whole tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.scalars import (
    coalesce_zero,
    epoch_or_iso_seconds,
    epoch_to_ts,
    guarded_epoch,
    null_of,
    pg_cast,
    surrogate_key,
)
from quarrymill.operators import lineage, paging
from quarrymill.plans import tables
from quarrymill.plans.registry import query
from quarrymill.plans.tables import cents, load, with_raw
from quarrymill.session import shared_dir
from quarrymill.sources.records import scan_past_target

_CENTS = "cast(cast({} as decimal(18,2)) * 100 as bigint)"
_UTC = "at time zone 'UTC'"


# --- projections ------------------------------------------------------------------------------


@query("project_columns", "select o_orderkey, o_custkey, o_orderstatus, o_orderdate from orders")
def project_columns(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")


@query("rename_columns", "select c_custkey as customer_id, c_name as name, c_mktsegment as segment from customer")
def rename_columns(spark, sf_dir):
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )


@query(
    "cte_chain",
    f"""with priced as (select l_suppkey, {_CENTS.format("l_extendedprice")} as amount from lineitem),
    per_supplier as (select l_suppkey, count(*) as lines, sum(amount) as amount from priced group by 1),
    final as (select s.s_name, s.s_nationkey, p.lines, p.amount
              from per_supplier p join supplier s on s.s_suppkey = p.l_suppkey)
    select s_name, s_nationkey, lines, cast(amount as bigint) as amount from final""",
)
def cte_chain(spark, sf_dir):
    priced = load(spark, sf_dir, "lineitem").select("l_suppkey", cents("l_extendedprice").alias("amount"))
    per_supplier = priced.groupBy("l_suppkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("amount").alias("amount")
    )
    supplier = load(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    return per_supplier.join(supplier, "l_suppkey").select("s_name", "s_nationkey", "lines", "amount")


@query("const_column", "select s_suppkey as id, 'seed' as source from supplier")
def const_column(spark, sf_dir):
    return load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.lit("seed").alias("source"))


@query("null_typed_column", "select s_suppkey as id, cast(null as timestamp) as created_at from supplier")
def null_typed_column(spark, sf_dir):
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), null_of("timestamp").alias("created_at")
    )


# --- filters ----------------------------------------------------------------------------------


@query(
    "filter_not_null",
    f"{with_raw('raw_stripe_customers')} select id, email from raw_stripe_customers where email is not null",
)
def filter_not_null(spark, sf_dir):
    return tables.raw_stripe_customers(spark, sf_dir).filter("email is not null").select("id", "email")


@query(
    "filter_is_null",
    f"{with_raw('raw_stripe_customers')} select id, name from raw_stripe_customers where email is null",
)
def filter_is_null(spark, sf_dir):
    return tables.raw_stripe_customers(spark, sf_dir).filter("email is null").select("id", "name")


@query(
    "filter_bool",
    f"{with_raw('raw_stripe_charges')} select id, customer, amount from raw_stripe_charges where paid",
)
def filter_bool(spark, sf_dir):
    return tables.raw_stripe_charges(spark, sf_dir).filter("paid").select("id", "customer", "amount")


@query("filter_eq", "select event_id, user_id, ts from events where event_type = 'click'")
def filter_eq(spark, sf_dir):
    clicks = load(spark, sf_dir, "events").filter(F.col("event_type") == "click")
    return clicks.select("event_id", "user_id", "ts")


@query(
    "filter_gt_max",
    """select l_orderkey, l_linenumber, l_shipdate from lineitem
    where l_shipdate > (select coalesce(max(o_orderdate), timestamp '1970-01-01') from orders)""",
)
def filter_gt_max(spark, sf_dir):
    """Only what is newer than the target, here lines shipped after the last order."""
    lines = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = load(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("l_shipdate"))
    return scan_past_target(lines, "l_shipdate", orders)


# --- joins ------------------------------------------------------------------------------------


@query(
    "join_inner_equi",
    """select o_orderkey, c_name, c_mktsegment, o_orderdate
    from orders join customer on c_custkey = o_custkey""",
)
def join_inner_equi(spark, sf_dir):
    orders, customer = load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return joined.select("o_orderkey", "c_name", "c_mktsegment", "o_orderdate")


@query(
    "join_left_chain",
    """select c.c_custkey, c.c_name, o.orders, o.last_order_at, e.events, e.last_event_at, l.parts
    from customer c
    left join (select o_custkey, count(*) as orders, max(o_orderdate) as last_order_at
               from orders group by 1) o on o.o_custkey = c.c_custkey
    left join (select user_id, count(*) as events, max(ts) as last_event_at
               from events group by 1) e on e.user_id = c.c_custkey
    left join (select l_suppkey, count(*) as parts from lineitem group by 1) l
           on l.l_suppkey = c.c_custkey""",
)
def join_left_chain(spark, sf_dir):
    """Sides hold one row per key before they meet; the joins share one partitioning by key."""
    orders = load(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("last_order_at")
    )
    events = load(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("events"), F.max("ts").alias("last_event_at")
    )
    parts = load(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("parts")
    )
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return reduce(lambda left, right: left.join(right, "c_custkey", "left"), [orders, events, parts], customer)


@query(
    "join_left_then_group",
    f"""select n_name, count(c_custkey) as customers, cast(sum({_CENTS.format("c_acctbal")}) as bigint) as balance
    from nation left join customer on c_nationkey = n_nationkey group by 1""",
)
def join_left_then_group(spark, sf_dir):
    """Customers are summed by nation first, so the join meets at most one row per nation."""
    per_nation = load(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("c_custkey").alias("customers"), F.sum(cents("c_acctbal")).alias("balance")
    )
    nation = load(spark, sf_dir, "nation")
    return nation.join(per_nation, "n_nationkey", "left").groupBy("n_name").agg(
        coalesce_zero(F.sum("customers")).alias("customers"), F.sum("balance").alias("balance")
    )


@query(
    "join_on_true",
    """select o_orderkey, o_orderdate, newest from orders
    join (select max(l_shipdate) as newest from lineitem) on true""",
)
def join_on_true(spark, sf_dir):
    """A one-row relation beside every row: a scalar subquery, never a cross product."""
    newest = load(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).scalar()
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", newest.alias("newest"))


# --- aggregations -----------------------------------------------------------------------------


@query(
    "agg_group",
    f"""select o_custkey, count(*) as order_count,
           cast(sum({_CENTS.format("o_totalprice")}) as bigint) as total_cents, max(o_orderdate) as last_order_at
    from orders group by 1""",
)
def agg_group(spark, sf_dir):
    return load(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum(cents("o_totalprice")).alias("total_cents"),
        F.max("o_orderdate").alias("last_order_at"),
    )


@query(
    "agg_count_col",
    f"""{with_raw('raw_stripe_customers')}
    select currency, livemode, count(email) as with_email, count(*) as all_rows
    from raw_stripe_customers group by 1, 2""",
)
def agg_count_col(spark, sf_dir):
    return tables.raw_stripe_customers(spark, sf_dir).groupBy("currency", "livemode").agg(
        F.count("email").alias("with_email"), F.count(F.lit(1)).alias("all_rows")
    )


@query(
    "agg_filter",
    f"""{with_raw('raw_stripe_charges')}
    select customer, count(*) filter (where refunded) as refunds,
           cast(sum(amount) filter (where paid) as bigint) as paid_cents,
           cast(sum(amount) filter (where refunded and not paid) as bigint) as lost_cents
    from raw_stripe_charges group by 1""",
)
def agg_filter(spark, sf_dir):
    """A sum without any matching row is NULL, a count is zero."""
    return tables.raw_stripe_charges(spark, sf_dir).groupBy("customer").agg(
        F.count_if("refunded").alias("refunds"),
        F.sum(F.when(F.col("paid"), F.col("amount"))).alias("paid_cents"),
        F.sum(F.when(F.col("refunded") & ~F.col("paid"), F.col("amount"))).alias("lost_cents"),
    )


@query(
    "agg_having",
    """select l_orderkey, count(*) as n_lines, sum(l_quantity) as quantity from lineitem
    group by 1 having count(*) >= 5 and sum(l_quantity) > 150""",
)
def agg_having(spark, sf_dir):
    totals = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")
    )
    return totals.filter("n_lines >= 5 AND quantity > 150")


@query("agg_global_max", "select max(ts) as newest_event, max(event_id) as last_id from events")
def agg_global_max(spark, sf_dir):
    return load(spark, sf_dir, "events").agg(
        F.max("ts").alias("newest_event"), F.max("event_id").alias("last_id")
    )


@query(
    "agg_count_subquery",
    """select count(*) as repeated from
    (select l_orderkey, l_linenumber from lineitem group by 1, 2 having count(*) > 1) t""",
)
def agg_count_subquery(spark, sf_dir):
    copies = load(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").count().filter("count > 1")
    return copies.agg(F.count(F.lit(1)).alias("repeated"))


# --- sorts and limits -------------------------------------------------------------------------


@query(
    "sort_result",
    f"""{with_raw('raw_stripe_customers')}
    select id, email from raw_stripe_customers order by email desc nulls first, id""",
)
def sort_result(spark, sf_dir):
    """NULLs where the warehouse puts them: first when descending, last when ascending."""
    rows = tables.raw_stripe_customers(spark, sf_dir).select("id", "email")
    return rows.orderBy(F.col("email").desc_nulls_first(), F.col("id").asc_nulls_last())


@query(
    "keyset_page_deep",
    """select event_id, ts, user_id, event_type from events
    order by ts, event_id limit 100 offset (select count(*) // 2 from events)""",
)
def keyset_page_deep(spark, sf_dir):
    """A page from the middle of all events, of which one or two ranges are read."""
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    path = f"{shared_dir(spark)}/pages_{uuid.uuid4().hex}"
    paging.write_pages(events, path, ["ts", "event_id"], 16)
    return paging.keyset_page(spark, path, ["ts", "event_id"], events.count() // 2, 100)


@query(
    "keyset_page",
    """select event_id, ts, user_id, event_type from events where ts > timestamp '2024-01-10'
    order by ts, event_id limit 5000""",
)
def keyset_page(spark, sf_dir):
    """One page past a mark; the limit is the operator. The id breaks ties at the page's edge."""
    past = load(spark, sf_dir, "events").filter(F.col("ts") > F.lit("2024-01-10").cast("timestamp_ntz"))
    return past.select("event_id", "ts", "user_id", "event_type").orderBy("ts", "event_id").limit(5000)


@query(
    "limit_n",
    "select o_orderkey, o_orderdate from orders order by o_orderdate desc, o_orderkey limit 10",
)
def limit_n(spark, sf_dir):
    newest_first = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate").orderBy(*newest_first).limit(10)


# --- set operations ---------------------------------------------------------------------------


@query(
    "union_all",
    """select c_custkey as id, c_name as name, 'postgres' as source from customer
    union all select s_suppkey, s_name, 'seed' from supplier""",
)
def union_all(spark, sf_dir):
    first = load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("postgres").alias("source")
    )
    second = load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.lit("seed").alias("source")
    )
    return first.unionByName(second)


def _ids(spark, sf_dir, table: str, column: str) -> DataFrame:
    return load(spark, sf_dir, table).select(F.col(column).alias("id"))


@query("set_union", "select o_custkey as id from orders union select user_id from events")
def set_union(spark, sf_dir):
    return lineage.set_union(
        _ids(spark, sf_dir, "orders", "o_custkey"), _ids(spark, sf_dir, "events", "user_id")
    )


@query("set_intersect", "select o_custkey as id from orders intersect select user_id from events")
def set_intersect(spark, sf_dir):
    return lineage.set_intersect(
        _ids(spark, sf_dir, "orders", "o_custkey"), _ids(spark, sf_dir, "events", "user_id")
    )


# --- scalar functions -------------------------------------------------------------------------


@query(
    "surrogate_key",
    f"""{with_raw('raw_stripe_customers')}
    select id, md5(id || 'stripe') as customer_key, md5(email || 'stripe') as email_key
    from raw_stripe_customers""",
)
def surrogate_key_query(spark, sf_dir):
    return tables.raw_stripe_customers(spark, sf_dir).select(
        "id",
        surrogate_key("id", "stripe").alias("customer_key"),
        surrogate_key("email", "stripe").alias("email_key"),
    )


@query(
    "coalesce_zero",
    f"""{with_raw('raw_stripe_subscriptions')}
    select id, cast(coalesce(canceled_at, 0) as bigint) as canceled from raw_stripe_subscriptions""",
)
def coalesce_zero_query(spark, sf_dir):
    return tables.raw_stripe_subscriptions(spark, sf_dir).select("id", coalesce_zero("canceled_at").alias("canceled"))


@query(
    "epoch_to_ts",
    f"""{with_raw('raw_stripe_charges')}
    select id, to_timestamp(created) {_UTC} as created_at from raw_stripe_charges""",
)
def epoch_to_ts_query(spark, sf_dir):
    return tables.raw_stripe_charges(spark, sf_dir).select("id", epoch_to_ts("created").alias("created_at"))


@query(
    "guarded_epoch",
    f"""{with_raw('raw_stripe_subscriptions')}
    select id, case when canceled_at is not null then to_timestamp(canceled_at) {_UTC} end as canceled_at,
           cast(null as timestamp) as ended_at
    from raw_stripe_subscriptions""",
)
def guarded_epoch_query(spark, sf_dir):
    return tables.raw_stripe_subscriptions(spark, sf_dir).select(
        "id", guarded_epoch("canceled_at").alias("canceled_at"), guarded_epoch("ended_at").alias("ended_at")
    )


@query(
    "cast_ops",
    """select cast(event_id as varchar) as id_text, cast(regexp_extract(props, '"k": *([0-9]+)', 1) as bigint) as k,
           cast(cast(ts as varchar) as timestamp) as at
    from events""",
)
def cast_ops(spark, sf_dir):
    return load(spark, sf_dir, "events").select(
        pg_cast("event_id", "text").alias("id_text"),
        pg_cast(F.get_json_object("props", "$.k"), "bigint").alias("k"),
        pg_cast(F.col("ts").cast("string"), "timestamptz").alias("at"),
    )


@query("lower_text", "select doc_id, lower(lang) as lang, lower(source) as source from documents")
def lower_text(spark, sf_dir):
    return load(spark, sf_dir, "documents").select(
        "doc_id", F.lower("lang").alias("lang"), F.lower("source").alias("source")
    )


@query("concat_text", "select p_partkey, p_brand || ' ' || p_type || ' ' || p_name as label from part")
def concat_text(spark, sf_dir):
    space = F.lit(" ")
    return load(spark, sf_dir, "part").select(
        "p_partkey", F.concat("p_brand", space, "p_type", space, "p_name").alias("label")
    )


@query(
    "epoch_or_iso_seconds",
    """select event_id, case event_type
             when 'error' then null
             when 'click' then cast(floor(epoch(ts)) as bigint)
             when 'view' then cast(epoch(date_trunc('day', ts)) as bigint)
             else event_id end as seconds
    from events""",
)
def epoch_or_iso_seconds_query(spark, sf_dir):
    """Cursors as sources write them: digits, a timestamp, a date or something else."""
    kind, ts = F.col("event_type"), F.col("ts").cast("string")
    written = (
        F.when(kind == "error", "unknown")
        .when(kind == "click", F.concat(F.translate(ts, " ", "T"), F.lit("Z")))
        .when(kind == "view", F.substring(ts, 1, 10))
        .otherwise(F.col("event_id").cast("string"))
    )
    return load(spark, sf_dir, "events").select("event_id", epoch_or_iso_seconds(written).alias("seconds"))
