"""The demo project as one job: land every source, load the seeds, publish the models, test them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrymill.operators.cursors import Extract, StreamConfig, load_streams
from quarrymill.operators.quality import TestedModel, run_column_tests
from quarrymill.plans import models, tables
from quarrymill.sinks.store import LoadResult, Store, publish_incremental, publish_table, publish_view, write_replace
from quarrymill.sources.records import scan_cursor

# How the demo declares its streams.
STREAMS = {
    "postgres": {
        "customers": StreamConfig("merge", primary_key="id", cursor_field="created_at"),
        "orders": StreamConfig("append", cursor_field="created_at"),
    },
    "clickhouse": {
        "events": StreamConfig("append", cursor_field="created_at"),
    },
    "stripe": {
        "customers": StreamConfig("merge", primary_key="id", cursor_field="created"),
        "charges": StreamConfig("append", cursor_field="created"),
        "subscriptions": StreamConfig("append", cursor_field="created"),
    },
}


def land(spark: SparkSession, store: Store, sf_dir: str) -> list[LoadResult]:
    """Load every declared stream past its mark."""
    results = []
    for source, streams in STREAMS.items():

        def extract_of(stream: str, config: StreamConfig, source: str = source) -> Extract:
            upstream = getattr(tables, f"raw_{source}_{stream}")(spark, sf_dir)
            return lambda mark: scan_cursor(upstream, config.cursor_field, mark, inclusive=config.inclusive)

        results += load_streams(store, source, streams, extract_of)
    return results


def load_seed_tables(spark: SparkSession, store: Store, sf_dir: str) -> list[LoadResult]:
    return [
        write_replace(store, "seed_customers", tables.raw_seed_customers(spark, sf_dir)),
        write_replace(store, "seed_orders", tables.raw_seed_orders(spark, sf_dir)),
    ]


# The staging models as the catalog keeps them, `{0}` being the raw table.
_STRIPE_TIME = "timestamp_seconds(cast({} as bigint)) as {}"
STAGING_VIEWS = {
    "postgres_customers": ("raw_postgres_customers", "id, name, email, created_at"),
    "postgres_orders": ("raw_postgres_orders", "id, customer_id, amount, status, created_at"),
    "clickhouse_events": ("raw_clickhouse_events", "id, user_id, event_type, page_url, created_at"),
    "seed_customers": ("seed_customers", "id, name, email"),
    "seed_orders": ("seed_orders", "id, customer_id, amount"),
    "stripe_customers": (
        "raw_stripe_customers",
        f"id, email, name, currency, livemode, {_STRIPE_TIME.format('created', 'created_at')}",
    ),
    "stripe_charges": (
        "raw_stripe_charges",
        "id, customer as customer_id, amount as amount_cents, amount_refunded as amount_refunded_cents, currency, "
        f"status, paid, captured, refunded, disputed, {_STRIPE_TIME.format('created', 'created_at')}",
    ),
    "stripe_subscriptions": (
        "raw_stripe_subscriptions",
        "id, customer as customer_id, status, currency, cancel_at_period_end, "
        + ", ".join(
            _STRIPE_TIME.format(raw, name)
            for raw, name in [
                ("created", "created_at"),
                ("start_date", "started_at"),
                ("canceled_at", "canceled_at"),
                ("ended_at", "ended_at"),
            ]
        ),
    ),
}


def publish_staging(store: Store) -> None:
    """The staging models as views of the catalog, which follow their raw tables."""
    for name, (raw, columns) in STAGING_VIEWS.items():
        publish_view(store, f"stg_{name}", f"select {columns} from {store.name(raw)}")


def build(store: Store) -> DataFrame:
    """Publish the models in the order of their dependencies; returns the test results.

    Staging models and the order counts are views, the other marts tables built from those views.
    """
    publish_staging(store)
    publish_table(
        store, "customers", models.customers(store.table("stg_postgres_customers"), store.table("stg_seed_customers"))
    )
    publish_view(
        store,
        "customer_order_counts",
        f"""select c.id as customer_id, c.name, coalesce(o.n, 0) as order_count, coalesce(o.total, 0) as total_amount
            from {store.name("customers")} c
            left join (select md5(concat(cast(customer_id as string), 'postgres')) as customer_id, n, total
                       from (select customer_id, count(id) as n, sum(amount) as total
                             from {store.name("stg_postgres_orders")} group by customer_id)) o
              on o.customer_id = c.id""",
    )
    publish_table(
        store,
        "customer_activity",
        models.customer_activity(
            store.table("customers"),
            store.table("stg_clickhouse_events"),
            store.table("stg_postgres_orders"),
            store.table("stg_seed_orders"),
            store.table("stg_stripe_customers"),
            store.table("stg_stripe_charges"),
            store.table("stg_stripe_subscriptions"),
        ),
    )
    publish_incremental(store, "fct_events", models.fct_events(store.table("stg_clickhouse_events")), "event_id")
    publish_view(
        store, "rpt_events", f"select user_id, count(*) as n from {store.name('fct_events')} group by user_id"
    )
    tested = TestedModel("customer_activity", store.table("customer_activity"), models.ACTIVITY_TESTS)
    return run_column_tests(store.spark, [tested])
