"""The shipped models as DataFrame functions: staging projections, then the marts.

Marts aggregate by the raw id before they build surrogate keys, so md5 runs once per customer and
the large shuffles carry the narrow id. Every fact is reduced to one row per key before a join, and
facts with the same key are put side by side in one row by regrouping their union, so that the
customers are joined once per key.
Nothing is sorted here: order a result where it is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.scalars import coalesce_zero, epoch_to_ts, guarded_epoch, null_of, surrogate_key
from quarrymill.operators.skew import own_shuffle

ACTIVITY_TESTS = {"customer_id": ["unique", "not_null"], "customer_source": ["not_null"]}


# --- staging ----------------------------------------------------------------------------------


def stg_postgres_customers(raw: DataFrame) -> DataFrame:
    return raw.select("id", "name", "email", "created_at")


def stg_postgres_orders(raw: DataFrame) -> DataFrame:
    return raw.select("id", "customer_id", "amount", "status", "created_at")


def stg_clickhouse_events(raw: DataFrame) -> DataFrame:
    return raw.select("id", "user_id", "event_type", "page_url", "created_at")


def stg_seed_customers(raw: DataFrame) -> DataFrame:
    return raw.select("id", "name", "email")


def stg_seed_orders(raw: DataFrame) -> DataFrame:
    return raw.select("id", "customer_id", "amount")


def stg_stripe_customers(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id", "email", "name", "currency", "livemode", epoch_to_ts("created").alias("created_at")
    )


def stg_stripe_charges(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        F.col("customer").alias("customer_id"),
        F.col("amount").alias("amount_cents"),
        F.col("amount_refunded").alias("amount_refunded_cents"),
        "currency",
        "status",
        "paid",
        "captured",
        "refunded",
        "disputed",
        epoch_to_ts("created").alias("created_at"),
    )


def stg_stripe_subscriptions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "id",
        F.col("customer").alias("customer_id"),
        "status",
        "currency",
        "cancel_at_period_end",
        epoch_to_ts("created").alias("created_at"),
        epoch_to_ts("start_date").alias("started_at"),
        guarded_epoch("canceled_at").alias("canceled_at"),
        guarded_epoch("ended_at").alias("ended_at"),
    )


# --- marts ------------------------------------------------------------------------------------


def customers(postgres_customers: DataFrame, seed_customers: DataFrame) -> DataFrame:
    """Customers of both sources under one surrogate key; seeds carry no creation time."""
    from_postgres = postgres_customers.select(
        surrogate_key("id", "postgres").alias("id"),
        "name",
        "email",
        "created_at",
        F.lit("postgres").alias("source"),
    )
    created_type = postgres_customers.schema["created_at"].dataType.simpleString()
    from_seed = seed_customers.select(
        surrogate_key("id", "seed").alias("id"),
        "name",
        "email",
        null_of(created_type).alias("created_at"),
        F.lit("seed").alias("source"),
    )
    return from_postgres.unionByName(from_seed)


def _keyed_by_customer(per_id: DataFrame, id_col: str, source: str) -> DataFrame:
    """Replace a raw id, which is never NULL here, by the surrogate key it has in `source`.

    The key is declared non-NULL. Otherwise Catalyst, wanting no NULLs in a join, would move the
    test whether md5 is NULL below the aggregate and run it on every fact.
    """
    key = F.coalesce(surrogate_key(id_col, source), F.lit(""))
    return per_id.withColumn("id", key).drop(id_col)


def customer_order_counts(all_customers: DataFrame, postgres_orders: DataFrame) -> DataFrame:
    """Orders and amount per customer; customers without orders count zero."""
    per_customer = (
        postgres_orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count("id").alias("orders"), F.sum("amount").alias("amount"))
    )
    return customer_order_counts_of(all_customers, per_customer)


def customer_order_counts_of(all_customers: DataFrame, per_customer: DataFrame) -> DataFrame:
    """The same from `orders` and `amount` of each raw customer id, as totals keep them."""
    return (
        all_customers.join(_keyed_by_customer(per_customer, "customer_id", "postgres"), "id", "left")
        .groupBy(F.col("id").alias("customer_id"), "name")
        .agg(
            coalesce_zero(F.sum("orders")).alias("order_count"),
            coalesce_zero(F.sum("amount")).alias("total_amount"),
        )
    )


def _orders_per_customer(orders: DataFrame, source: str) -> DataFrame:
    dated = "created_at" in orders.columns
    per_customer = (
        orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            F.sum("amount").alias("total_spent"),
            *([F.max("created_at").alias("last_order_at")] if dated else []),
        )
    )
    return _keyed_by_customer(per_customer, "customer_id", source)


def _events_per_customer(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    per_user = (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_if(kind == "page_view").alias("page_views"),
            F.count_if(kind == "click").alias("clicks"),
            F.count_if(kind == "purchase").alias("purchases"),
            F.max("created_at").alias("last_event_at"),
        )
    )
    return _keyed_by_customer(per_user, "user_id", "postgres")


def _side_by_side(facts: DataFrame, key: str) -> DataFrame:
    """One row per key: counts and amounts added up, the latest of each time."""
    measures = [name for name in facts.columns if name != key]
    return facts.groupBy(key).agg(
        *[(F.max if name.startswith("last_") else F.sum)(name).alias(name) for name in measures]
    )


def activity_by_customer(events: DataFrame, postgres_orders: DataFrame, seed_orders: DataFrame) -> DataFrame:
    """One row per customer key: orders of both sources and events."""
    facts = (
        _orders_per_customer(postgres_orders, "postgres")
        .unionByName(_orders_per_customer(seed_orders, "seed"), allowMissingColumns=True)
        .unionByName(_events_per_customer(events), allowMissingColumns=True)
    )
    return _side_by_side(facts, "id")


def billing_by_email(charges: DataFrame, subscriptions: DataFrame, billed: DataFrame) -> DataFrame:
    """One row per e-mail address: its charges and subscriptions.

    Both facts are summed per billing customer first. That leaves one join with the customers and
    one regrouping by e-mail, on rows as few as customers, instead of a join on the facts.
    """
    charged = charges.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("stripe_charge_count"),
        F.sum(F.when(F.col("paid"), F.col("amount_cents"))).alias("stripe_paid_cents"),
        F.sum("amount_refunded_cents").alias("stripe_refunded_cents"),
        F.max("created_at").alias("last_stripe_charge_at"),
    )
    subscribed = subscriptions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("stripe_subscription_count"),
        F.count_if(F.col("status") == "active").alias("active_stripe_subscriptions"),
        F.max("created_at").alias("last_stripe_subscription_at"),
    )
    facts = charged.unionByName(subscribed, allowMissingColumns=True)
    addresses = billed.filter(F.col("email").isNotNull()).select(F.col("id").alias("customer_id"), "email")
    return _side_by_side(facts.join(addresses, "customer_id").drop("customer_id"), "email")


def customer_activity(
    all_customers: DataFrame,
    events: DataFrame,
    postgres_orders: DataFrame,
    seed_orders: DataFrame,
    stripe_customers: DataFrame,
    stripe_charges: DataFrame,
    stripe_subscriptions: DataFrame,
) -> DataFrame:
    """Orders, events and billing of every customer on one row."""
    activity = activity_by_customer(events, postgres_orders, seed_orders)
    billing = billing_by_email(stripe_charges, stripe_subscriptions, stripe_customers)
    # Ids are unique, but very many customers may share an address or have none.
    joined = all_customers.join(activity, "id", "left").join(own_shuffle(billing, "email"), "email", "left")
    return joined.select(
        F.col("id").alias("customer_id"),
        "name",
        "email",
        F.col("source").alias("customer_source"),
        F.col("created_at").alias("customer_since"),
        coalesce_zero("order_count").alias("order_count"),
        coalesce_zero("total_spent").alias("total_spent"),
        "last_order_at",
        coalesce_zero("event_count").alias("event_count"),
        coalesce_zero("page_views").alias("page_views"),
        coalesce_zero("clicks").alias("clicks"),
        coalesce_zero("purchases").alias("purchases"),
        "last_event_at",
        coalesce_zero("stripe_charge_count").alias("stripe_charge_count"),
        coalesce_zero("stripe_paid_cents").alias("stripe_paid_cents"),
        coalesce_zero("stripe_refunded_cents").alias("stripe_refunded_cents"),
        "last_stripe_charge_at",
        coalesce_zero("stripe_subscription_count").alias("stripe_subscription_count"),
        coalesce_zero("active_stripe_subscriptions").alias("active_stripe_subscriptions"),
        "last_stripe_subscription_at",
    )


def fct_events(events: DataFrame) -> DataFrame:
    """Incremental by `event_id`."""
    return events.select(
        F.col("id").alias("event_id"), "user_id", F.col("created_at").alias("occurred_at")
    )


def rpt_events(facts: DataFrame) -> DataFrame:
    return facts.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
