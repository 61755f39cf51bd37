"""The demo's raw tables, derived from the analytics tables this repository is tested on.

| raw table            | derived from                                                             |
| -------------------- | ------------------------------------------------------------------------ |
| postgres customers   | `customer`, with an e-mail made of the name                               |
| postgres orders      | `orders`                                                                 |
| clickhouse events    | `events`; `view` is the demo's `page_view`, the page comes from `props`   |
| seed customers       | `supplier`, sharing the addresses of the customers of the same number     |
| seed orders          | `lineitem` by supplier                                                    |
| stripe customers     | `customer`                                                               |
| stripe charges       | `lineitem`; some of the parts it charges are no customers                 |
| stripe subscriptions | `orders`                                                                 |

The `RAW_SQL` texts say the same to DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SINCE = "2024-01-15 10:00:00"


_schemas: dict[str, T.StructType] = {}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by name. Its schema is read from a footer once; naming it saves a job per read."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def cents(price: str) -> Column:
    """Prices are doubles with two decimals, so the nearest whole number of cents is exact."""
    return F.rint(F.col(price) * 100).cast("bigint")


def epoch(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def _email(name: Column) -> Column:
    return F.concat(F.lower(name), F.lit("@example.com"))


def raw_postgres_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        _email(F.col("c_name")).alias("email"),
        F.lit(SINCE).cast("timestamp").alias("created_at"),
    )


def raw_postgres_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def raw_clickhouse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.when(kind == "view", "page_view").otherwise(kind).alias("event_type"),
        F.concat(F.lit("/"), F.get_json_object("props", "$.k")).alias("page_url"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


def raw_seed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad(F.col("s_suppkey").cast("string"), 9, "0")
    return load(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
        _email(F.concat(F.lit("customer#"), number)).alias("email"),
    )


def raw_seed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        F.col("l_suppkey").alias("customer_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
    )


def raw_stripe_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(
        F.concat(F.lit("cus_"), F.col("c_custkey").cast("string")).alias("id"),
        F.when(F.col("c_mktsegment") != "MACHINERY", _email(F.col("c_name"))).alias("email"),
        F.col("c_name").alias("name"),
        F.lit("usd").alias("currency"),
        (F.col("c_acctbal") >= 0).alias("livemode"),
        (F.lit(1_700_000_000) + F.col("c_custkey")).alias("created"),
    )


def raw_stripe_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    refunded = F.col("l_returnflag") == "R"
    paid = F.col("l_linestatus") == "F"
    amount = cents("l_extendedprice")
    return load(spark, sf_dir, "lineitem").select(
        F.concat_ws("_", F.lit("ch"), "l_orderkey", "l_linenumber").alias("id"),
        F.concat(F.lit("cus_"), F.col("l_partkey").cast("string")).alias("customer"),
        amount.alias("amount"),
        F.when(refunded, amount).otherwise(F.lit(0)).cast("bigint").alias("amount_refunded"),
        F.lit("usd").alias("currency"),
        F.when(paid, "succeeded").otherwise("pending").alias("status"),
        paid.alias("paid"),
        paid.alias("captured"),
        refunded.alias("refunded"),
        F.lit(False).alias("disputed"),
        epoch("l_shipdate").alias("created"),
    )


def raw_stripe_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    started = epoch("o_orderdate")
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("sub_"), F.col("o_orderkey").cast("string")).alias("id"),
        F.concat(F.lit("cus_"), F.col("o_custkey").cast("string")).alias("customer"),
        F.when(status == "O", "active").when(status == "F", "canceled").otherwise("past_due").alias("status"),
        F.lit("usd").alias("currency"),
        (status == "P").alias("cancel_at_period_end"),
        started.alias("created"),
        (started + 86_400).alias("start_date"),
        F.when(status == "F", started + 864_000).alias("canceled_at"),
        F.lit(None).cast("string").alias("ended_at"),
    )


RAW_SQL = {
    "raw_postgres_customers": f"""
        select c_custkey as id, c_name as name, lower(c_name) || '@example.com' as email,
               timestamp '{SINCE}' as created_at
        from customer""",
    "raw_postgres_orders": """
        select o_orderkey as id, o_custkey as customer_id,
               cast(o_totalprice as decimal(18,2)) as amount, o_orderstatus as status,
               o_orderdate as created_at
        from orders""",
    "raw_clickhouse_events": """
        select event_id as id, user_id,
               case when event_type = 'view' then 'page_view' else event_type end as event_type,
               '/' || regexp_extract(props, '"k": *([0-9]+)', 1) as page_url, ts as created_at
        from events""",
    "raw_seed_customers": """
        select s_suppkey as id, s_name as name,
               'customer#' || lpad(cast(s_suppkey as varchar), 9, '0') || '@example.com' as email
        from supplier""",
    "raw_seed_orders": """
        select l_orderkey as id, l_suppkey as customer_id,
               cast(l_extendedprice as decimal(18,2)) as amount
        from lineitem""",
    "raw_stripe_customers": """
        select 'cus_' || c_custkey as id,
               case when c_mktsegment <> 'MACHINERY' then lower(c_name) || '@example.com' end as email,
               c_name as name, 'usd' as currency, c_acctbal >= 0 as livemode,
               cast(1700000000 + c_custkey as bigint) as created
        from customer""",
    "raw_stripe_charges": """
        select 'ch_' || l_orderkey || '_' || l_linenumber as id, 'cus_' || l_partkey as customer,
               cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) as amount,
               case when l_returnflag = 'R'
                    then cast(cast(l_extendedprice as decimal(18,2)) * 100 as bigint) else 0 end
                    as amount_refunded,
               'usd' as currency,
               case when l_linestatus = 'F' then 'succeeded' else 'pending' end as status,
               l_linestatus = 'F' as paid, l_linestatus = 'F' as captured,
               l_returnflag = 'R' as refunded, false as disputed,
               cast(floor(epoch(l_shipdate)) as bigint) as created
        from lineitem""",
    "raw_stripe_subscriptions": """
        select 'sub_' || o_orderkey as id, 'cus_' || o_custkey as customer,
               case o_orderstatus when 'O' then 'active' when 'F' then 'canceled'
                    else 'past_due' end as status,
               'usd' as currency, o_orderstatus = 'P' as cancel_at_period_end,
               cast(floor(epoch(o_orderdate)) as bigint) as created,
               cast(floor(epoch(o_orderdate)) as bigint) + 86400 as start_date,
               case when o_orderstatus = 'F'
                    then cast(floor(epoch(o_orderdate)) as bigint) + 864000 end as canceled_at,
               cast(null as varchar) as ended_at
        from orders""",
}


def with_raw(*names: str) -> str:
    """A `with` head that defines the raw tables a query reads."""
    return "with " + ",\n".join(f"{name} as ({RAW_SQL[name]})" for name in names)
