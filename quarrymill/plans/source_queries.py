"""Sources and type inference. Files are written from the tables first, so that work grows with them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions import inference, types
from quarrymill.plans.registry import query
from quarrymill.plans.tables import load
from quarrymill.session import shared_dir
from quarrymill.sinks import store as sinks
from quarrymill.sources import api_pages, csv_seed, landed, records
from quarrymill.streaming.file_load import land_stream


def _landing(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}_{uuid.uuid4().hex}"


def _write_csv(df: DataFrame, path: str) -> str:
    (
        df.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("emptyValue", "")
        .csv(path)
    )
    return path


# Stored bytes of a table that go into one file whose fields hold line breaks.
_FILE_BYTES = 256 << 20


# --- CSV --------------------------------------------------------------------------------------


@query(
    "scan_csv_seed",
    "select doc_id, nullif(text, '') as text, lang, source, n_chars from documents",
)
def scan_csv_seed(spark, sf_dir):
    """Whole documents: quotes, commas and line breaks inside fields."""
    path = _write_csv(load(spark, sf_dir, "documents"), _landing(spark, "documents") + ".csv")
    return csv_seed.scan_csv_seed(spark, path)


@query(
    "scan_csv_breaks",
    "select doc_id, nullif(text, '') as text, lang, source, n_chars from documents",
)
def scan_csv_breaks(spark, sf_dir):
    """Whole documents in one file, read by as many tasks as it has splits although fields hold line breaks.

    A file is written by one task, so that tables of more than `_FILE_BYTES` become several files, each still of many splits.
    """
    documents = load(spark, sf_dir, "documents")
    size = spark.read.format("binaryFile").load(f"{sf_dir}/documents.parquet").agg(F.sum("length")).first()[0] or 0
    files = documents.coalesce(max(1, -(-size // _FILE_BYTES)))
    return csv_seed.scan_csv_seed(spark, _write_csv(files, _landing(spark, "breaks") + ".csv"), split=True)


@query(
    "scan_csv_split",
    """select l_orderkey, l_suppkey, cast(l_linenumber as bigint) as l_linenumber, cast(l_extendedprice as double) as l_extendedprice,
           l_returnflag, l_shipdate from lineitem""",
)
def scan_csv_split(spark, sf_dir):
    """Lines without breaks inside fields: Spark splits the files."""
    lines = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag", "l_shipdate"
    )
    return csv_seed.scan_csv_seed(spark, _write_csv(lines, _landing(spark, "lines") + ".csv"), multiline=False)


def _seed_tree(spark, sf_dir) -> str:
    root = _landing(spark, "seeds")
    for place in ("customer", "supplier"):
        _write_csv(load(spark, sf_dir, place), f"{root}/crm/{place}.csv")
    _write_csv(load(spark, sf_dir, "part"), f"{root}/part.csv")
    return root


@query(
    "scan_seed_tree",
    """select 'seed_crm_customer' as name, count(*) > 0 as filled from customer
    union all select 'seed_crm_supplier', count(*) > 0 from supplier
    union all select 'seed_part', count(*) > 0 from part""",
)
def scan_seed_tree(spark, sf_dir):
    found = csv_seed.scan_seed_tree(spark, _seed_tree(spark, sf_dir))
    return found.select("name", (F.col("bytes") > 0).alias("filled"))


@query(
    "load_seeds",
    """select 'customer' as seed, c_custkey as id, c_name as name, cast(c_acctbal as double) as amount from customer
    union all select 'supplier', s_suppkey, s_name, cast(s_acctbal as double) from supplier
    union all select 'part', p_partkey, p_name, cast(p_retailprice as double) from part""",
)
def load_seeds(spark, sf_dir):
    store = sinks.scratch_store(spark, "seeds")
    csv_seed.load_seeds(store, _seed_tree(spark, sf_dir))
    columns = {
        "crm_customer": ("c_custkey", "c_name", "c_acctbal"),
        "crm_supplier": ("s_suppkey", "s_name", "s_acctbal"),
        "part": ("p_partkey", "p_name", "p_retailprice"),
    }
    customer, supplier, part = (
        store.table(f"seed_{seed}").select(
            F.lit(seed.removeprefix("crm_")).alias("seed"),
            F.col(key).alias("id"),
            F.col(name).alias("name"),
            F.col(amount).alias("amount"),
        )
        for seed, (key, name, amount) in columns.items()
    )
    return customer.unionByName(supplier).unionByName(part)


_MIXED_SQL = """
    select 'id' as "column", cast(o_orderkey as varchar) as v from orders
    union all select 'price', case when o_orderstatus = 'O' then cast(cast(o_totalprice as bigint) as varchar)
                              else cast(cast(o_totalprice as decimal(18,2)) as varchar) end from orders
    union all select 'big', '9' || lpad(cast(o_orderkey as varchar), 19, '0') from orders
    union all select 'placed', case when o_orderstatus = 'F' then strftime(o_orderdate, '%Y-%m-%d')
                               else strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') end from orders
    union all select 'day', strftime(o_orderdate, '%Y-%m-%d') from orders
    union all select 'open', case when o_orderstatus = 'O' then 'True' when o_orderstatus = 'F' then 'false' end
              from orders
    union all select 'flag', case when o_orderstatus = 'O' then 'true' else '1' end from orders
    union all select 'late', case when o_orderstatus = 'P' then 'pending' else cast(o_custkey as varchar) end
              from orders
    union all select 'priority', o_orderpriority from orders
    union all select 'nothing', null from orders"""


@query(
    "infer_csv_types",
    rf"""with v as ({_MIXED_SQL}),
    k as (select "column", case
            when v is null then null
            when lower(v) in ('true', 'false') then 'boolean'
            when regexp_full_match(v, '\d{{4}}-\d{{2}}-\d{{2}}') then 'date'
            when regexp_full_match(v, '\d{{4}}-\d{{2}}-\d{{2}}[T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?(Z|[+-]\d{{2}}:?\d{{2}})?')
                then 'timestamptz'
            when regexp_full_match(v, '-?\d+')
                then case when try_cast(v as bigint) is not null then 'bigint' else 'numeric' end
            when regexp_full_match(v, '-?(\d+\.\d*|\.\d+)') then 'numeric'
            else 'text' end as kind
          from v),
    s as (select "column", list_sort(list(distinct kind) filter (where kind is not null)) as kinds from k group by 1)
    select "column", case when kinds is null or len(kinds) = 0 then 'text'
                          when len(kinds) = 1 then kinds[1]
                          when kinds = ['bigint', 'numeric'] then 'numeric'
                          when kinds = ['date', 'timestamptz'] then 'timestamptz'
                          else 'text' end as type
    from s""",
)
def infer_csv_types(spark, sf_dir):
    status, day = F.col("o_orderstatus"), F.col("o_orderdate")
    price = F.col("o_totalprice")
    mixed = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.when(status == "O", price.cast("bigint").cast("string"))
        .otherwise(price.cast("decimal(18,2)").cast("string"))
        .alias("price"),
        F.concat(F.lit("9"), F.lpad(F.col("o_orderkey").cast("string"), 19, "0")).alias("big"),
        F.when(status == "F", F.date_format(day, "yyyy-MM-dd"))
        .otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("placed"),
        F.date_format(day, "yyyy-MM-dd").alias("day"),
        F.when(status == "O", "True").when(status == "F", "false").alias("open"),
        F.when(status == "O", "true").otherwise("1").alias("flag"),
        F.when(status == "P", "pending").otherwise(F.col("o_custkey").cast("string")).alias("late"),
        F.col("o_orderpriority").alias("priority"),
        F.lit(None).cast("string").alias("nothing"),
    )
    found = inference.infer_csv_types(mixed)
    rows = [(name, kind.partition("(")[0]) for name, kind in found.items()]
    return spark.createDataFrame(rows, "column string, type string")


# --- JSON -------------------------------------------------------------------------------------


def _mixed_json(spark, sf_dir) -> DataFrame:
    """Records whose keys come and go and change their type, one per event."""
    kind, value = F.col("event_type"), F.col("value")
    odd = F.when(kind == "click", value).otherwise(F.floor(value))
    record = F.when(
        kind == "error",
        F.to_json(
            F.struct(
                F.col("event_id").alias("id"),
                F.col("user_id").alias("mixed"),
                F.struct(F.lit("x").alias("z"), F.array(F.col("user_id")).alias("a")).alias("meta"),
                F.lit(None).cast("string").alias("gone"),
            ),
            {"ignoreNullFields": "false"},
        ),
    ).otherwise(
        F.to_json(
            F.struct(
                F.col("event_id").alias("id"),
                odd.alias("amount"),
                (kind == "purchase").alias("live"),
                kind.alias("mixed"),
                F.array("user_id").alias("users"),
                (F.col("user_id") * F.lit(1.0)).alias("whole"),
                F.lit(None).cast("string").alias("gone"),
            ),
            {"ignoreNullFields": "false"},
        )
    )
    return load(spark, sf_dir, "events").select("event_id", record.alias("doc"))


@query(
    "infer_json_types",
    """with r as (
      select 'id' as key, 2 as rank from events
      union all select 'mixed', case when event_type = 'error' then 2 else 4 end from events
      union all select 'meta', 5 from events where event_type = 'error'
      union all select 'gone', 0 from events
      union all select 'amount', case when value = floor(value) or event_type <> 'click' then 2 else 3 end
                from events where event_type <> 'error'
      union all select 'live', 1 from events where event_type <> 'error'
      union all select 'users', 5 from events where event_type <> 'error'
      union all select 'whole', 2 from events where event_type <> 'error'
      union all select 'k', 2 from events where props like '%"k"%')
    select key, case max(rank) when 1 then 'boolean' when 2 then 'bigint' when 3 then 'double precision'
                               when 5 then 'jsonb' else 'text' end as type
    from r group by 1""",
)
def infer_json_types(spark, sf_dir):
    """Two columns of JSON: the built records and the events' own properties."""
    built = inference.json_type_table(_mixed_json(spark, sf_dir), "doc")
    own = inference.json_type_table(load(spark, sf_dir, "events"), "props")
    return built.unionByName(own)


@query(
    "stringify_nested",
    """select event_id,
           case when event_type = 'error' then '{"z":"x","a":[' || user_id || ']}' end as meta,
           case when event_type <> 'error' then '[' || user_id || ']' end as users
    from events""",
)
def stringify_nested(spark, sf_dir):
    records_ = _mixed_json(spark, sf_dir)
    return inference.stringify_nested(records_, "doc", {"meta": "jsonb", "users": "jsonb", "id": "bigint"})


@query("scan_jsonl", "select event_id as id, user_id, event_type, ts as created_at, value from events")
def scan_jsonl(spark, sf_dir):
    """64-bit integers arrive quoted, as ClickHouse writes them."""
    events = load(spark, sf_dir, "events")
    lines = events.select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("id"),
                "user_id",
                "event_type",
                F.col("ts").cast("string").alias("created_at"),
                "value",
            )
        )
    )
    path = _landing(spark, "lines")
    lines.write.text(path)
    declared = {
        "id": "UInt64",
        "user_id": "UInt32",
        "event_type": "LowCardinality(String)",
        "created_at": "Nullable(DateTime64(6, 'UTC'))",
        "value": "Float64",
    }
    return records.scan_jsonl(spark, path, declared)


# --- API pages --------------------------------------------------------------------------------


def _customer_pages(spark, sf_dir) -> DataFrame:
    """Pages of a hundred customers: the page follows from the dense key, so it is that long."""
    customer = load(spark, sf_dir, "customer")
    item = F.struct(
        F.col("c_custkey").alias("key"),
        F.concat(F.lit("cus_"), F.col("c_custkey").cast("string")).alias("id"),
        F.lower("c_name").alias("name"),
        F.struct(F.col("c_mktsegment").alias("segment")).alias("metadata"),
        F.col("c_acctbal").alias("balance"),
    )
    page = F.floor(F.col("c_custkey") / 100).alias("page")
    gathered = customer.groupBy(page).agg(F.sort_array(F.collect_list(item)).alias("data"))
    return gathered.select(
        "page",
        F.to_json(
            F.struct(
                F.lit("list").alias("object"),
                F.concat(F.lit("/v1/customers?page="), F.col("page").cast("string")).alias("url"),
                F.lit(True).alias("has_more"),
                "data",
            )
        ).alias("value"),
    )


@query(
    "scan_api_pages",
    """select c_custkey // 100 as page, cast(c_custkey % 100 as int) as position, c_custkey as key,
           'cus_' || c_custkey as id, lower(c_name) as name, '{"segment":"' || c_mktsegment || '"}' as metadata,
           c_acctbal as balance
    from customer""",
)
def scan_api_pages(spark, sf_dir):
    path = _landing(spark, "pages")
    _customer_pages(spark, sf_dir).select("value").write.text(path)
    landed = api_pages.read_pages(spark, path).select("value")
    number = F.regexp_extract(F.get_json_object("value", "$.url"), r"page=(\d+)", 1).cast("bigint")
    items = api_pages.scan_api_pages(landed.withColumn("page", number))
    # Bring the one column that may look integral in small data to the type it declares.
    return api_pages.typed_records(items).withColumn("balance", F.col("balance").cast("double"))


_CUSTOMERS_SQL = """select c_custkey // 100 as page, cast(c_custkey % 100 as int) as position, c_custkey as key from customer"""


def _landed_customers(pages: DataFrame) -> DataFrame:
    items = api_pages.scan_api_pages(pages.drop("file"))
    return items.select("page", "position", F.get_json_object("record", "$.key").cast("bigint").alias("key"))


@query("scan_landed_pages", _CUSTOMERS_SQL)
def scan_landed_pages(spark, sf_dir):
    """The pages as files of one page each, read through a data source of this library."""
    path = _landing(spark, "landed")
    _customer_pages(spark, sf_dir).write.partitionBy("page").text(path)
    return _landed_customers(landed.read_landed(spark, path, pagesPerPartition=4))


@query("stream_landed_pages", _CUSTOMERS_SQL)
def stream_landed_pages(spark, sf_dir):
    """The same as a stream, in three runs: pages that come before an earlier one has landed wait for it."""
    store, path = sinks.scratch_store(spark, "landed"), _landing(spark, "landed_stream")
    pages = _customer_pages(spark, sf_dir)
    sinks.clone_empty(store, "pages", spark.createDataFrame([], "page bigint, file string, value string"))
    first, hole = F.col("page") < 2, F.col("page") == 2
    for wave in (first, ~first & ~hole, hole):
        pages.filter(wave).write.mode("append").partitionBy("page").text(path)
        run = land_stream(store, "pages", landed.read_landed(spark, path, stream=True), f"{path}_checkpoint")
        run.awaitTermination()
    return _landed_customers(store.table("pages"))


@query(
    "page_chain_audit",
    """with p as (
      select conv_id as stream, turn as page, role = 'user' as has_more,
             if(conv_id % 5 = 0 and turn = 2, 0, 1) as n,
             if(conv_id % 3 = 0 and turn = 0, null, role) as last_id
      from conversations),
    q as (
      select *, lag(page) over w as prev, lag(has_more) over w as prev_more, lag(last_id) over w as prev_id,
             lead(page) over w as next
      from p window w as (partition by stream order by page))
    select stream, page, problem from (
      select stream, page, unnest([
        case when stream % 7 = 0 and page = 1 then 'copied' end,
        case when prev <> page - 1 then 'gap before' end,
        case when prev = page - 1 and not prev_more then 'after the end' end,
        case when next is null and has_more and n > 0 then 'cut off' end,
        case when next is not null and n = 0 then 'empty' end,
        case when next is not null and has_more and last_id is null then 'no id' end,
        case when prev = page - 1 and prev_id is distinct from 'user' then 'wrong cursor' end]) as problem
      from q)
    where problem is not null""",
)
def page_chain_audit(spark, sf_dir):
    """Conversations as page chains: a user's turn asks for more, a turn is one page; some are copied or empty."""
    stream, page = F.col("conv_id"), F.col("turn")
    turns = load(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        (F.col("role") == "user").alias("more"),
        F.when((stream % 5 == 0) & (page == 2), 0).otherwise(1).alias("rows"),
        F.when(~((stream % 3 == 0) & (page == 0)), F.col("role")).alias("last_id"),
        F.lit("user").alias("after"),
    )
    copied = turns.filter((stream % 7 == 0) & (page == 1))
    return api_pages.page_chain_audit(
        turns.unionByName(copied), "conv_id", "turn", "more", "rows", "last_id", "after"
    )


# --- declared types ---------------------------------------------------------------------------


@query(
    "apply_pg_types",
    """select o_orderkey, cast(o_custkey as int) as o_custkey, o_orderstatus,
           cast(cast(o_totalprice as decimal(18,2)) as double) as o_totalprice, o_orderdate,
           o_orderpriority from orders""",
)
def apply_pg_types(spark, sf_dir):
    text = load(spark, sf_dir, "orders")
    text = text.select(*[F.col(name).cast("string").alias(name) for name in text.columns])
    declared = {
        "o_orderkey": "bigint",
        "o_custkey": "integer",
        "o_orderstatus": "character",
        "o_totalprice": "numeric",
        "o_orderdate": "timestamp without time zone",
        "o_orderpriority": "USER-DEFINED",
    }
    return types.apply_pg_types(text, declared)


@query(
    "apply_clickhouse_types",
    """select l_orderkey, cast(l_linenumber as int) as l_linenumber, cast(l_quantity as float) as l_quantity,
           cast(cast(l_extendedprice as decimal(18,2)) as double) as l_extendedprice, l_discount,
           l_returnflag, l_linestatus = 'F' as l_closed, l_shipdate,
           cast(l_shipdate as date) as l_shipday from lineitem""",
)
def apply_clickhouse_types(spark, sf_dir):
    lines = load(spark, sf_dir, "lineitem")
    text = lines.select(
        *[
            F.col(name).cast("string").alias(name)
            for name in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
        ],
        (F.col("l_linestatus") == "F").cast("string").alias("l_closed"),
        F.col("l_shipdate").cast("string").alias("l_shipdate"),
        F.substring(F.col("l_shipdate").cast("string"), 1, 10).alias("l_shipday"),
    )
    declared = {
        "l_orderkey": "UInt64",
        "l_linenumber": "Nullable(UInt8)",
        "l_quantity": "Float32",
        "l_extendedprice": "Decimal(18, 2)",
        "l_discount": "LowCardinality(Nullable(Float64))",
        "l_returnflag": "FixedString(1)",
        "l_closed": "Bool",
        "l_shipdate": "DateTime64(3)",
        "l_shipday": "Date32",
    }
    return types.apply_clickhouse_types(text, declared)


@query(
    "coerce_literals",
    """select event_id, case when event_type <> 'error' then cast(user_id as int) end as user_id,
           case when event_type <> 'click' then ts end as ts,
           concat(case when event_type = 'error' then 'user_id' else '' end,
                  case when event_type = 'click' then 'ts' else '' end) as rejected
    from events""",
)
def coerce_literals(spark, sf_dir):
    """Values that do not fit their column are set aside by name instead of failing the load."""
    kind = F.col("event_type")
    text = load(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(kind == "error", "n/a").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.when(kind == "click", "2024-99-99").otherwise(F.col("ts").cast("string")).alias("ts"),
    )
    loaded = types.coerce_or_reject(text, {"event_id": "bigint", "user_id": "integer", "ts": "timestamp"})
    return loaded.withColumn("rejected", F.concat_ws(",", "rejected"))


@query(
    "rank_pages",
    """with recursive ends as (select conv_id, max(turn) as last from conversations group by 1),
    p as (
      select conv_id as stream, conv_id || ':' || turn as page,
             case when turn > 0 then conv_id || ':' || (turn - 1)
                  when conv_id % 5 = 0 then conv_id || ':' || last end as after,
             conv_id || ':' || turn as last_id
      from conversations join ends using (conv_id) where not (conv_id % 3 = 0 and conv_id % 5 <> 0 and turn = 1)
      union all
      select conv_id, conv_id || ':copy', conv_id || ':0', conv_id || ':copy'
      from conversations where conv_id % 7 = 0 and turn = 1),
    heads as (select stream, page, after from p
              where after is null or (stream, after) not in (select (stream, last_id) from p)),
    walk as (
      select p.stream, p.page, p.last_id, p.page as head, 0 as rank from p join heads using (stream, page)
      union all
      select p.stream, p.page, p.last_id, walk.head, walk.rank + 1
      from walk join p on p.stream = walk.stream and p.after = walk.last_id)
    select p.stream, p.page, head, cast(rank as bigint) as rank,
           case when head = p.page and p.after is not null then 'lost head'
                when p.after is not null and (select count(*) from p q where q.stream = p.stream and q.after = p.after) > 1 then 'fork'
                when rank is null then 'cycle' end as problem
    from p left join walk on walk.stream = p.stream and walk.page = p.page""",
)
def rank_pages(spark, sf_dir):
    """Conversations as chains of turns without numbers: some closed to a ring, some forked, some without their second turn."""
    turns = load(spark, sf_dir, "conversations").select("conv_id", "turn")
    conv, turn = F.col("conv_id"), F.col("turn")

    def name(number):
        return F.concat_ws(":", conv.cast("string"), number.cast("string"))

    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    after = F.when(turn > 0, name(turn - 1)).when(conv % 5 == 0, name(F.col("last")))
    given = turns.join(last, "conv_id").filter(~((conv % 3 == 0) & (conv % 5 != 0) & (turn == 1)))
    pages = given.select(conv.alias("stream"), name(turn).alias("page"), after.alias("after"), name(turn).alias("last_id"))
    forked = turns.filter((conv % 7 == 0) & (turn == 1)).select(
        conv.alias("stream"), name(F.lit("copy")).alias("page"), name(F.lit(0)).alias("after"), name(F.lit("copy")).alias("last_id")
    )
    return api_pages.rank_pages(pages.unionByName(forked), "stream", "page", "after", "last_id")
