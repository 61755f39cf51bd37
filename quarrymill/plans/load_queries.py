"""Load strategies, materializations and cursors: each query loads, then reads the table back.

The demo's two extracts of one table: the first has every order that is not pending, the second
every order that is not final, with a changed amount. Orders that are open occur in both.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.operators import cursors
from quarrymill.operators.upsert import key_facts, upsert
from quarrymill.plans import models, tables
from quarrymill.plans.model_queries import CUSTOMERS_SQL, customers_model, staged
from quarrymill.plans.registry import query
from quarrymill.plans.tables import cents, load, with_raw
from quarrymill.session import shared_dir
from quarrymill.sinks import store as sinks
from quarrymill.sources.records import scan_cursor, scan_table
from quarrymill.streaming.file_load import stream_load
from quarrymill.streaming.keyed_load import stream_newest

_AMOUNT = "cast(cast(o_totalprice as decimal(18,2)) * 100 as bigint)"
_EXTRACTS_SQL = f"""
first_extract as (select o_orderkey as id, {_AMOUNT} as amount, o_orderstatus as status
                  from orders where o_orderstatus <> 'P'),
second_extract as (select o_orderkey as id, {_AMOUNT} + 100 as amount, o_orderstatus as status
                   from orders where o_orderstatus <> 'F')"""
_MERGED_SQL = """
select * from first_extract where id not in (select id from second_extract)
union all select * from second_extract"""
_MID = "2024-01-15 12:00:00"


def first_extract(spark, sf_dir) -> DataFrame:
    orders = load(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'")
    return orders.select(
        F.col("o_orderkey").alias("id"), cents("o_totalprice").alias("amount"), F.col("o_orderstatus").alias("status")
    )


def second_extract(spark, sf_dir) -> DataFrame:
    orders = load(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        (cents("o_totalprice") + 100).alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )


# --- load strategies --------------------------------------------------------------------------


@query(
    "write_append",
    f"with {_EXTRACTS_SQL} select * from first_extract union all select *, null from "
    "(select id, amount from second_extract)",
)
def write_append(spark, sf_dir):
    """The second batch lacks a column, which becomes NULL."""
    store = sinks.scratch_store(spark, "append")
    sinks.write_append(store, "orders", first_extract(spark, sf_dir))
    sinks.write_append(store, "orders", second_extract(spark, sf_dir).drop("status"))
    return store.table("orders")


@query("write_replace", f"with {_EXTRACTS_SQL} select * from second_extract")
def write_replace(spark, sf_dir):
    store = sinks.scratch_store(spark, "replace")
    sinks.write_replace(store, "orders", first_extract(spark, sf_dir))
    sinks.write_replace(store, "orders", second_extract(spark, sf_dir))
    return store.table("orders")


@query(
    "write_merge",
    f"""with {_EXTRACTS_SQL}, merged as ({_MERGED_SQL})
    select id, if(status = 'O', 0, amount) as amount, if(status = 'O', 'late', status) as status from merged
    union all select -1, -1, 'late'""",
)
def write_merge(spark, sf_dir):
    """Two extracts folded in, then changes kept apart: an update of some rows and an insert."""
    store = sinks.scratch_store(spark, "merge")
    sinks.write_merge(store, "orders", first_extract(spark, sf_dir), "id")
    sinks.write_merge(store, "orders", second_extract(spark, sf_dir), "id")
    kind = store.table("orders").schema["amount"].dataType
    late = store.table("orders").filter("status = 'O'").select("id", F.lit(0).cast(kind).alias("amount"), F.lit("late").alias("status"))
    new = spark.range(1).select(F.lit(-1).cast(late.schema["id"].dataType).alias("id"), F.lit(-1).cast(kind).alias("amount"), F.lit("late").alias("status"))
    sinks.write_merge(store, "orders", late.unionByName(new), "id", apart=True)
    return store.table("orders")


@query(
    "write_merge_null_keys",
    """with a as (select case when o_orderpriority = '1-URGENT' then null else o_orderkey end as id,
                      o_orderstatus as status
               from orders where o_orderstatus <> 'P'),
    b as (select case when o_orderpriority = '1-URGENT' then null else o_orderkey end as id,
                 'new ' || o_orderstatus as status
          from orders where o_orderstatus <> 'F')
    select id, status from a where id is null or id not in (select id from b where id is not null)
    union all select id, status from b""",
)
def write_merge_null_keys(spark, sf_dir):
    """A fifth of the rows has no key: they never conflict, so all of them are appended."""
    store = sinks.scratch_store(spark, "merge_null")
    orders = load(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("id"),
        F.col("o_orderstatus").alias("status"),
    )
    sinks.write_merge(store, "orders", orders.filter("status <> 'P'"), "id")
    changed = orders.filter("status <> 'F'").withColumn("status", F.concat(F.lit("new "), "status"))
    sinks.write_merge(store, "orders", changed, "id")
    return store.table("orders")


@query(
    "write_merge_last_wins",
    """select user_id, arg_max(event_type, ts) as event_type, max(ts) as ts from events group by 1""",
)
def write_merge_last_wins(spark, sf_dir):
    """Many extracts in one batch: the newest row of a key wins."""
    store = sinks.scratch_store(spark, "merge_last")
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    sinks.write_merge(store, "users", events, "user_id", seq="ts")
    return store.table("users")


_BIG, _SMALL = 485_000, 15_000


@query(
    "write_merge_few_rows",
    f"""select o_orderkey as id,
           case when o_totalprice < {_SMALL} then -1 when o_totalprice > {_BIG} then 0
                else {_AMOUNT} end as amount,
           case when o_totalprice < {_SMALL} then 'fixed twice' when o_totalprice > {_BIG} then 'fixed'
                else o_orderstatus end as status
    from orders""",
)
def write_merge_few_rows(spark, sf_dir):
    """Corrections of few rows, twice: the large table stays as it is, the changes are kept apart."""
    store = sinks.scratch_store(spark, "merge_few")
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        cents("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )
    cheap, dear = F.col("amount") < _SMALL * 100, F.col("amount") > _BIG * 100
    sinks.write_merge(store, "orders", orders, "id")
    first = orders.filter(cheap | dear).select("id", F.lit(0).alias("amount"), F.lit("fixed").alias("status"))
    sinks.write_merge(store, "orders", first, "id")
    second = orders.filter(cheap).select("id", F.lit(-1).alias("amount"), F.lit("fixed twice").alias("status"))
    sinks.write_merge(store, "orders", second, "id")
    return store.table("orders")


@query(
    "write_merge_buckets",
    f"""select o_orderkey as id,
           case when o_totalprice < {_SMALL} then -1 when o_totalprice > {_BIG} then 0
                else {_AMOUNT} end as amount,
           case when o_totalprice < {_SMALL} then 'fixed twice' when o_totalprice > {_BIG} then 'fixed'
                else o_orderstatus end as status
    from orders union all select null, -1, 'no key' from orders where o_totalprice < {_SMALL}""",
)
def write_merge_buckets(spark, sf_dir):
    """The same corrections, and rows without a key, in a table laid out in buckets: only those that are touched are rewritten."""
    store = sinks.scratch_store(spark, "merge_buckets")
    orders = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        cents("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
    )
    cheap, dear = F.col("amount") < _SMALL * 100, F.col("amount") > _BIG * 100
    sinks.write_merge(store, "orders", orders, "id")
    sinks.lay_out_buckets(store, "orders", "id", 16)
    first = orders.filter(cheap | dear).select("id", F.lit(0).alias("amount"), F.lit("fixed").alias("status"))
    sinks.write_merge(store, "orders", first, "id")
    second = orders.filter(cheap).select("id", F.lit(-1).alias("amount"), F.lit("fixed twice").alias("status"))
    unkeyed = second.withColumn("id", F.lit(None)).withColumn("status", F.lit("no key"))
    sinks.write_merge(store, "orders", second.unionByName(unkeyed), "id")
    return store.table("orders")


@query("join_key_match", f"with {_EXTRACTS_SQL} {_MERGED_SQL}")
def join_key_match(spark, sf_dir):
    """The upsert itself, from one DataFrame into another."""
    updates = second_extract(spark, sf_dir)
    return upsert(first_extract(spark, sf_dir), updates, "id", key_facts(updates, "id"))


@query(
    "typed_create",
    f"""with {_EXTRACTS_SQL}
    select cast(id as bigint) as id, cast(amount as double) as amount, cast(null as varchar) as note
    from second_extract""",
)
def typed_create(spark, sf_dir):
    """A column without a declared type is text; text rows are cast on the way in."""
    store = sinks.scratch_store(spark, "typed")
    sinks.typed_create(store, "orders", {"id": "bigint", "amount": "numeric(18,2)", "note": None})
    text = second_extract(spark, sf_dir).select(F.col("id").cast("string"), F.col("amount").cast("string"))
    sinks.write_append(store, "orders", text)
    return store.table("orders")


@query("clone_empty", f"with {_EXTRACTS_SQL} select * from second_extract")
def clone_empty(spark, sf_dir):
    store = sinks.scratch_store(spark, "clone")
    sinks.clone_empty(store, "orders", first_extract(spark, sf_dir))
    sinks.write_append(store, "orders", second_extract(spark, sf_dir))
    return store.table("orders")


# --- materializations -------------------------------------------------------------------------


@query("publish_view", "select user_id, count(*) as n, max(ts) as last_at from events group by 1")
def publish_view(spark, sf_dir):
    """A catalog view over a loaded table; replacing the table under it leaves the view in place."""
    store = sinks.scratch_store(spark, "view")
    events = load(spark, sf_dir, "events").select("user_id", "ts")
    sinks.publish_table(store, "events", events.limit(0))
    sinks.publish_view(
        store,
        "users",
        f"select user_id, count(*) as n, max(ts) as last_at from {store.name('events')} group by 1",
    )
    sinks.publish_table(store, "events", events)
    return store.table("users")


@query(
    "publish_table",
    f"{with_raw('raw_postgres_customers', 'raw_seed_customers')} select * from ({CUSTOMERS_SQL})",
)
def publish_table(spark, sf_dir):
    """A model that reads its own previous version while the next one is built."""
    store = sinks.scratch_store(spark, "table")
    customers = customers_model(spark, sf_dir)
    sinks.publish_table(store, "customers", customers.filter("source = 'seed'"))
    rest = customers.filter("source <> 'seed'")
    sinks.publish_table(store, "customers", store.table("customers").unionByName(rest))
    return store.table("customers")


@query(
    "publish_incremental",
    f"""with {_EXTRACTS_SQL}
    select id, amount, status, status || '!' as mark from first_extract
    where id not in (select id from second_extract)
    union all
    select s.id, s.amount, s.status, f.status || '!' from second_extract s left join first_extract f on f.id = s.id""",
)
def publish_incremental(spark, sf_dir):
    """A column the model no longer has keeps its value in updated rows and is NULL in new ones."""
    store = sinks.scratch_store(spark, "incremental")
    marked = first_extract(spark, sf_dir).withColumn("mark", F.concat("status", F.lit("!")))
    sinks.publish_incremental(store, "orders", marked, "id")
    sinks.publish_incremental(store, "orders", second_extract(spark, sf_dir), "id")
    return store.table("orders")


@query("fct_events", "select event_id, user_id, ts as occurred_at from events")
def fct_events(spark, sf_dir):
    """Two incremental builds: the second sees all events again and adds what is new."""
    store = sinks.scratch_store(spark, "fct")
    events = models.fct_events(staged(spark, sf_dir, "clickhouse_events"))
    early = events.filter(F.col("occurred_at") <= F.lit(_MID).cast("timestamp"))
    sinks.publish_incremental(store, "fct_events", early, "event_id")
    sinks.publish_incremental(store, "fct_events", events, "event_id")
    return store.table("fct_events")


@query("scan_table", "select o_orderkey, o_custkey, o_orderdate from orders")
def scan_table_query(spark, sf_dir):
    store = sinks.scratch_store(spark, "scan")
    sinks.write_replace(store, "raw_postgres_orders", load(spark, sf_dir, "orders"))
    orders = scan_table(spark, store.name("raw_postgres_orders"))
    return orders.select("o_orderkey", "o_custkey", "o_orderdate")


@query(
    "preview",
    f"""{with_raw('raw_postgres_customers', 'raw_seed_customers')}
    select * from ({CUSTOMERS_SQL}) order by id limit 10""",
)
def preview(spark, sf_dir):
    store = sinks.scratch_store(spark, "preview")
    sinks.publish_table(store, "customers", customers_model(spark, sf_dir))
    return sinks.preview(store, "customers", 10, order_by=["id"])


# --- cursors ----------------------------------------------------------------------------------


def _marks(events: DataFrame, value) -> DataFrame:
    """One mark per event type, as if each type were a source of its own."""
    return events.groupBy(F.col("event_type").alias("source_name")).agg(
        F.lit("events:ts").alias("stream"), value.cast("string").alias("value")
    )


_MARKS_SQL = """select event_type as source_name, 'events:ts' as stream, cast(max(ts) as varchar) as value
from events {} group by 1"""


@query("cursor_set", _MARKS_SQL.format(""))
def cursor_set(spark, sf_dir):
    """The second set of a key replaces the first."""
    store = sinks.scratch_store(spark, "cursor_set")
    events = load(spark, sf_dir, "events")
    cursors.set_cursors(store, _marks(events, F.min("ts")))
    cursors.set_cursors(store, _marks(events, F.max("ts")))
    return cursors.cursors(store).drop("updated_at")


@query("cursor_get", "select 'click' as source_name, cast(max(ts) as varchar) as value from events where event_type = 'click'")
def cursor_get(spark, sf_dir):
    store = sinks.scratch_store(spark, "cursor_get")
    cursors.set_cursors(store, _marks(load(spark, sf_dir, "events"), F.max("ts")))
    value = cursors.cursor_get(store, "click", "events:ts")
    return spark.createDataFrame([("click", value)], "source_name string, value string")


@query("cursor_clear", _MARKS_SQL.format("where event_type <> 'error'"))
def cursor_clear(spark, sf_dir):
    store = sinks.scratch_store(spark, "cursor_clear")
    cursors.set_cursors(store, _marks(load(spark, sf_dir, "events"), F.max("ts")))
    cursors.cursor_clear(store, "error", "events:ts")
    return cursors.cursors(store).drop("updated_at")


@query("scan_cursor", f"select event_id, ts, user_id from events where ts > timestamp '{_MID}'")
def scan_cursor_query(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return scan_cursor(events, "ts", stored=_MID, initial="2023-01-01")


@query(
    "next_cursor",
    """select 'id' as stream, cast(max(event_id) as varchar) as value from events
    union all select 'ts', cast(max(ts) as varchar) from events
    union all select 'kept', cast(greatest(max(o_orderdate), timestamp '2030-01-01 00:00:00') as varchar) from orders""",
)
def next_cursor(spark, sf_dir):
    """Compared as numbers and times, not as text; an older batch never moves a mark back."""
    events, orders = load(spark, sf_dir, "events"), load(spark, sf_dir, "orders")
    parts = {
        "id": cursors.next_cursor(events, "event_id", previous="9"),
        "ts": cursors.next_cursor(events, "ts"),
        "kept": cursors.next_cursor(orders, "o_orderdate", previous="2030-01-01 00:00:00"),
    }
    named = [df.select(F.lit(name).alias("stream"), "value") for name, df in parts.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _events_extract(spark, sf_dir):
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    return lambda mark: scan_cursor(events, "ts", mark)


_EVENTS = cursors.StreamConfig("append", cursor_field="ts", initial_value=_MID)


@query(
    "load_stream",
    f"select event_id, ts, user_id, event_type from events where ts > timestamp '{_MID}'",
)
def load_stream(spark, sf_dir):
    """Two loads of a stream with an initial value: the second finds nothing past the mark."""
    store = sinks.scratch_store(spark, "load")
    extract = _events_extract(spark, sf_dir)
    for _ in range(2):
        cursors.load_stream(store, "clickhouse", "default.events", extract, _EVENTS)
    return store.table("raw_clickhouse_default_events")


@query("full_refresh", "select event_id, ts, user_id, event_type from events")
def full_refresh(spark, sf_dir):
    """The mark is forgotten first, so everything comes back, although it was loaded before."""
    store = sinks.scratch_store(spark, "refresh")
    extract = _events_extract(spark, sf_dir)
    whole = cursors.StreamConfig("append", cursor_field="ts")
    cursors.load_stream(store, "clickhouse", "events", extract, whole)
    cursors.load_stream(store, "clickhouse", "events", extract, whole, full_refresh=True)
    return store.table("raw_clickhouse_events")


@query(
    "load_summary",
    f"""select 'raw_clickhouse_events' as target, count(*) as rows from events where ts > timestamp '{_MID}'
    union all select 'raw_postgres_orders', count(*) from orders
    union all select 'raw_clickhouse_events', 0""",
)
def load_summary(spark, sf_dir):
    store = sinks.scratch_store(spark, "summary")
    extract = _events_extract(spark, sf_dir)
    orders = tables.raw_postgres_orders(spark, sf_dir)
    results = [
        cursors.load_stream(store, "clickhouse", "events", extract, _EVENTS),
        cursors.load_stream(store, "postgres", "orders", lambda mark: orders),
        cursors.load_stream(store, "clickhouse", "events", extract, _EVENTS),
    ]
    summary = sinks.load_summary(spark, results)
    return summary.select(F.substring_index("target", ".", -1).alias("target"), "rows")


@query("stream_load", "select event_id, ts, user_id, event_type from events")
def stream_load_query(spark, sf_dir):
    """Rows arrive by batch, by stream in two waves, and by batch again; the table is compacted in between."""
    store = sinks.scratch_store(spark, "stream")
    landing = f"{shared_dir(spark)}/landing_{uuid.uuid4().hex}"
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    early = F.col("ts") <= F.lit(_MID).cast("timestamp_ntz")
    by_batch = F.col("event_id") % 4
    sinks.write_append(store, "raw_events", events.filter(by_batch == 0))
    for wave in (events.filter(early), events.filter(~early)):
        wave.filter(by_batch >= 2).write.mode("append").parquet(landing)
        run = stream_load(store, "raw_events", landing, events.schema, f"{landing}_checkpoint")
        run.awaitTermination()
        sinks.compact(store, "raw_events")
    sinks.write_append(store, "raw_events", events.filter(by_batch == 1))
    return store.table("raw_events")


@query(
    "stream_load_merge",
    """select user_id, arg_max(event_type, ts) as event_type, max(ts) as ts, max_files
    from events, (select unnest([1, 1000]) as max_files) group by user_id, max_files""",
)
def stream_load_merge(spark, sf_dir):
    """The later rows land first, with small batches and with large ones: the greatest sequence wins either way."""
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    early = F.col("ts") <= F.lit(_MID).cast("timestamp_ntz")
    results = []
    for max_files in (1, 1000):
        store = sinks.scratch_store(spark, "stream_merge")
        landing = f"{shared_dir(spark)}/landing_{uuid.uuid4().hex}"
        for wave in (events.filter(~early), events.filter(early)):
            wave.coalesce(2).write.mode("append").parquet(landing)
            run = stream_load(
                store, "users", landing, events.schema, f"{landing}_checkpoint", "merge",
                key="user_id", seq="ts", max_files=max_files,
            )
            run.awaitTermination()
        results.append(store.table("users").withColumn("max_files", F.lit(max_files)))
    return results[0].unionByName(results[1])


@query(
    "stream_load_keyed",
    "select user_id, arg_max(event_type, ts) as event_type, max(ts) as ts from events group by user_id",
)
def stream_load_keyed(spark, sf_dir):
    """Three runs of one stream: the later half, all rows again with those that are late by then, and repeats only."""
    store = sinks.scratch_store(spark, "stream_keyed")
    landing = f"{shared_dir(spark)}/landing_{uuid.uuid4().hex}"
    events = load(spark, sf_dir, "events").select("user_id", "event_type", "ts")
    late = F.col("ts") <= F.lit(_MID).cast("timestamp_ntz")
    for wave in (events.filter(~late), events, events.filter(late)):
        wave.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(events.schema).parquet(landing)
        stream_newest(store, "users", arriving, f"{landing}_checkpoint", "user_id", "ts").awaitTermination()
    return store.table("users")


@query(
    "load_stream_ties",
    f"""select event_id, ts, user_id, event_type from events
    where ts <= timestamp '{_MID}' or event_id % 5 <> 0""",
)
def load_stream_ties(spark, sf_dir):
    """An inclusive cursor: rows that arrive later with the mark's value come in, an older one moves no mark."""
    store = sinks.scratch_store(spark, "ties")
    events = load(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    config = cursors.StreamConfig("merge", primary_key="event_id", cursor_field="ts", inclusive=True)
    first = F.col("ts") <= F.lit(_MID).cast("timestamp_ntz")
    mark = events.filter(first).agg(F.max("ts").alias("ts"))
    tied = events.join(mark, "ts", "left_semi")
    arrivals = [
        events.filter(first).join(tied.select("event_id"), "event_id", "left_anti").unionByName(tied.limit(1)),
        events.filter(first),
        events.filter(first).limit(1),
        events.filter(first | (F.col("event_id") % 5 != 0)),
    ]
    for number, arrived in enumerate(arrivals):
        late = number == 2  # an extract that holds nothing but an old row

        def extract(mark, arrived=arrived, late=late):
            return arrived if late else scan_cursor(arrived, "ts", mark, inclusive=True)

        cursors.load_stream(store, "clickhouse", "events", extract, config)
    return store.table("raw_clickhouse_events")
