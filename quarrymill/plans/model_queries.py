"""Every shipped model over the analytics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions.scalars import surrogate_key
from quarrymill.operators.quality import TestedModel, all_passed, run_column_tests
from quarrymill.operators.totals import Totals, merge_with_totals
from quarrymill.plans import demo_job, models, tables
from quarrymill.plans.registry import query
from quarrymill.plans.tables import with_raw
from quarrymill.sinks.store import lay_out_buckets, scratch_store


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A staging model by the name of its raw table."""
    raw = getattr(tables, f"raw_{name}")(spark, sf_dir)
    return getattr(models, f"stg_{name}")(raw)


def customers_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.customers(
        staged(spark, sf_dir, "postgres_customers"), staged(spark, sf_dir, "seed_customers")
    )


def activity_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.customer_activity(
        customers_model(spark, sf_dir),
        staged(spark, sf_dir, "clickhouse_events"),
        staged(spark, sf_dir, "postgres_orders"),
        staged(spark, sf_dir, "seed_orders"),
        staged(spark, sf_dir, "stripe_customers"),
        staged(spark, sf_dir, "stripe_charges"),
        staged(spark, sf_dir, "stripe_subscriptions"),
    )


# The checks ask customer by customer, by raw id and origin, where the models group and join facts; md5 keys are
# made at the end.
PEOPLE_SQL = """(
    select 'postgres' as origin, id as raw_id, name, email, created_at from raw_postgres_customers
    union all by name
    select 'seed' as origin, id as raw_id, name, email from raw_seed_customers)"""

CUSTOMERS_SQL = f"""
    select md5(concat(raw_id, origin)) as id, name, email, created_at, origin as source
    from {PEOPLE_SQL}"""

_SPENT_SQL = """(
    select 'postgres' as origin, customer_id as raw_id, amount, created_at from raw_postgres_orders
    union all by name
    select 'seed' as origin, customer_id as raw_id, amount from raw_seed_orders)"""


def _stripe(what: str, table: str) -> str:
    """An aggregate over a customer's rows of a Stripe table, found by e-mail."""
    return f"""(select {what} from {table} x
                where x.customer in (select id from raw_stripe_customers k where k.email = p.email))"""


def _seen(what: str) -> str:
    """An aggregate over the events of a customer; only one origin has any."""
    return f"(select {what} from raw_clickhouse_events v where v.user_id = p.raw_id and p.origin = 'postgres')"


def _spent(what: str) -> str:
    return f"(select {what} from {_SPENT_SQL} d where d.raw_id = p.raw_id and d.origin = p.origin)"


def _stage_sql(raw: str, columns: str) -> str:
    return f"{with_raw(raw)} select {columns} from {raw}"


_UTC = "at time zone 'UTC'"

_STAGE_COLUMNS = {
    "postgres_customers": "id, name, email, created_at",
    "postgres_orders": "id, customer_id, cast(amount as double) as amount, status, created_at",
    "clickhouse_events": "id, user_id, event_type, page_url, created_at",
    "seed_customers": "id, name, email",
    "seed_orders": "id, customer_id, cast(amount as double) as amount",
    "stripe_customers": f"id, email, name, currency, livemode, to_timestamp(created) {_UTC} as created_at",
    "stripe_charges": f"""id, customer as customer_id, amount as amount_cents,
        amount_refunded as amount_refunded_cents, currency, status, paid, captured, refunded, disputed,
        to_timestamp(created) {_UTC} as created_at""",
    "stripe_subscriptions": f"""id, customer as customer_id, status, currency, cancel_at_period_end,
        to_timestamp(created) {_UTC} as created_at, to_timestamp(start_date) {_UTC} as started_at,
        case when canceled_at is not null then to_timestamp(canceled_at) {_UTC} end as canceled_at,
        case when ended_at is not null then to_timestamp(cast(ended_at as bigint)) {_UTC} end as ended_at""",
}


def _register_staging(name: str, columns: str) -> None:
    @query(f"stg_{name}", _stage_sql(f"raw_{name}", columns))
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return staged(spark, sf_dir, name)


for _name, _columns in _STAGE_COLUMNS.items():
    _register_staging(_name, _columns)


@query(
    "customers",
    f"{with_raw('raw_postgres_customers', 'raw_seed_customers')} select * from ({CUSTOMERS_SQL})",
)
def customers(spark, sf_dir):
    return customers_model(spark, sf_dir)


@query(
    "customer_order_counts",
    f"""{with_raw("raw_postgres_customers", "raw_seed_customers", "raw_postgres_orders")}
    select md5(concat(raw_id, origin)) as customer_id, name,
           (select count(*) from raw_postgres_orders d where d.customer_id = raw_id and origin = 'postgres') as order_count,
           cast(coalesce((select sum(amount) from raw_postgres_orders d
                          where d.customer_id = raw_id and origin = 'postgres'), 0) as double) as total_amount
    from {PEOPLE_SQL}""",
)
def customer_order_counts(spark, sf_dir):
    return models.customer_order_counts(
        customers_model(spark, sf_dir), staged(spark, sf_dir, "postgres_orders")
    )


ORDER_TOTALS = Totals(
    "order_totals",
    "customer_id",
    sums={"orders": "1", "amount": "amount"},
    latest={"last_order_at": "created_at"},
)


@query(
    "customer_order_counts_incremental",
    f"""{with_raw("raw_postgres_customers", "raw_seed_customers", "raw_postgres_orders")},
    moved as (select id, case when id % 5 = 0 then customer_id + 1 else customer_id end as customer_id,
                     case when status = 'O' then amount + 1 else amount end as amount, created_at
              from raw_postgres_orders)
    select md5(concat(raw_id, origin)) as customer_id, name,
           (select count(*) from moved d where d.customer_id = raw_id and origin = 'postgres') as order_count,
           cast(coalesce((select sum(amount) from moved d
                          where d.customer_id = raw_id and origin = 'postgres'), 0) as double) as total_amount,
           (select max(d.created_at) from moved d where d.customer_id = raw_id and origin = 'postgres') as last_order_at
    from {PEOPLE_SQL}""",
)
def customer_order_counts_incremental(spark, sf_dir):
    """Two loads of orders, then changed amounts and orders that go to another customer: the totals follow."""
    store = scratch_store(spark, "totals")
    orders = staged(spark, sf_dir, "postgres_orders")
    late = F.col("status") == "O"
    for load in (orders.filter(~late), orders.filter(late)):
        merge_with_totals(store, "orders", load, "id", ORDER_TOTALS)
    lay_out_buckets(store, "orders", "id", 16)
    changed = orders.withColumn("amount", F.when(late, F.col("amount") + 1).otherwise(F.col("amount")).cast(orders.schema["amount"].dataType))
    moved = changed.withColumn(
        "customer_id", F.when(F.col("id") % 5 == 0, F.col("customer_id") + 1).otherwise(F.col("customer_id"))
    )
    merge_with_totals(store, "orders", moved.filter(late | (F.col("id") % 5 == 0)), "id", ORDER_TOTALS)
    totals = store.table("order_totals")
    counts = models.customer_order_counts_of(customers_model(spark, sf_dir), totals)
    latest = totals.select(surrogate_key("customer_id", "postgres").alias("customer_id"), "last_order_at")
    return counts.join(latest, "customer_id", "left")


_ACTIVITY_QUERY = f"""
    {with_raw("raw_postgres_customers", "raw_seed_customers", "raw_postgres_orders", "raw_seed_orders",
              "raw_clickhouse_events", "raw_stripe_customers", "raw_stripe_charges", "raw_stripe_subscriptions")}
    select md5(concat(raw_id, origin)) as customer_id, name, email, origin as customer_source,
           created_at as customer_since,
           {_spent("count(*)")} as order_count,
           cast({_spent("coalesce(sum(amount), 0)")} as double) as total_spent,
           {_spent("max(created_at)")} as last_order_at,
           {_seen("count(*)")} as event_count,
           {_seen("count(case when event_type = 'page_view' then 1 end)")} as page_views,
           {_seen("count(case when event_type = 'click' then 1 end)")} as clicks,
           {_seen("count(case when event_type = 'purchase' then 1 end)")} as purchases,
           {_seen("max(created_at)")} as last_event_at,
           {_stripe("count(*)", "raw_stripe_charges")} as stripe_charge_count,
           cast({_stripe("coalesce(sum(if(paid, amount, 0)), 0)", "raw_stripe_charges")} as bigint)
             as stripe_paid_cents,
           cast({_stripe("coalesce(sum(amount_refunded), 0)", "raw_stripe_charges")} as bigint)
             as stripe_refunded_cents,
           {_stripe("max(to_timestamp(created))", "raw_stripe_charges")} {_UTC} as last_stripe_charge_at,
           {_stripe("count(*)", "raw_stripe_subscriptions")} as stripe_subscription_count,
           {_stripe("count(case when status = 'active' then 1 end)", "raw_stripe_subscriptions")} as active_stripe_subscriptions,
           {_stripe("max(to_timestamp(created))", "raw_stripe_subscriptions")} {_UTC} as last_stripe_subscription_at
    from {PEOPLE_SQL} p"""


@query("customer_activity", _ACTIVITY_QUERY)
def customer_activity(spark, sf_dir):
    return activity_model(spark, sf_dir)


@query("demo_build", _ACTIVITY_QUERY)
def demo_build(spark, sf_dir):
    """Land, seed, build and test the whole project in a store of its own, then land and build again."""
    store = scratch_store(spark, "demo")
    for _ in range(2):
        demo_job.land(spark, store, sf_dir)
        demo_job.load_seed_tables(spark, store, sf_dir)
        results = demo_job.build(store)
    if not all_passed(results):
        raise ValueError("the demo's column tests failed")
    return store.table("customer_activity")


@query("rpt_events", "select user_id, count(*) as n from events group by 1")
def rpt_events(spark, sf_dir):
    return models.rpt_events(models.fct_events(staged(spark, sf_dir, "clickhouse_events")))


@query(
    "customer_activity_tests",
    f"""{with_raw("raw_postgres_customers", "raw_seed_customers")},
    c as ({CUSTOMERS_SQL}),
    t as (
      select 'customer_id' as "column", 'unique' as test,
             (select count(*) from (select id from c where id is not null group by 1 having count(*) > 1)) as failures
      union all select 'customer_id', 'not_null', (select count(*) from c where id is null)
      union all select 'customer_source', 'not_null', (select count(*) from c where source is null))
    select 'customer_activity' as model, "column", test,
           case when failures = 0 then 'pass' else 'fail' end as status, failures
    from t""",
)
def customer_activity_tests(spark, sf_dir):
    model = TestedModel("customer_activity", activity_model(spark, sf_dir), models.ACTIVITY_TESTS)
    return run_column_tests(spark, [model]).select("model", "column", "test", "status", "failures")
