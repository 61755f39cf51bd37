"""The shipped models on the demo's rows."""

from decimal import Decimal

import pytest

from quarrymill.plans import models

# The demo's rows.
CUSTOMERS = [
    (1, "Alice", "alice@example.com"),
    (2, "Bob", "bob@example.com"),
    (3, "Charlie", "charlie@example.com"),
    (4, "Diana", "diana@example.com"),
]
ORDERS = [(101, 1, 100), (102, 1, 50), (103, 2, 200), (104, 2, 75), (105, 2, 125), (106, 3, 300), (107, 4, 50)]
SEED_ORDERS = [(10, 1, 100), (11, 1, 50), (12, 2, 200), (13, 2, 75), (14, 2, 125)]
EVENTS = [
    (10, 4, "page_view", "2026-04-14"), (11, 4, "page_view", "2026-04-14"), (12, 1, "page_view", "2026-04-15"),
    (13, 2, "purchase", "2026-04-16"), (14, 3, "click", "2026-04-17"), (15, 4, "signup", "2026-04-18"),
    (1, 1, "page_view", "2026-04-21"), (2, 1, "click", "2026-04-21"), (3, 1, "purchase", "2026-04-21"),
    (4, 2, "page_view", "2026-04-22"), (5, 2, "page_view", "2026-04-22"), (6, 2, "click", "2026-04-22"),
    (7, 3, "page_view", "2026-04-23"), (8, 3, "signup", "2026-04-23"), (9, 3, "page_view", "2026-04-23"),
]

EXPECTED = {
    "218e525d54a4b3a8e72598428c11e78c": ("Alice", "postgres", 2, 150, 4, 2, 1, 1),
    "f9c6a49ad2d073a63f55f9f8e2074e0f": ("Bob", "postgres", 3, 400, 4, 2, 1, 1),
    "d97157000d564dc48c38ce3da04affa2": ("Charlie", "postgres", 1, 300, 4, 2, 1, 0),
    "f3c17f536c6fa60bda2764e462c35021": ("Diana", "postgres", 1, 50, 3, 2, 0, 0),
    "d3a68ace9732b3b91304b446ac5710fb": ("Alice", "seed", 2, 150, 0, 0, 0, 0),
    "52514e2a3ec1bf72362b7a8799ce6a0d": ("Bob", "seed", 3, 400, 0, 0, 0, 0),
    "3941d793e7e1a74bd288fd7230232fbb": ("Charlie", "seed", 0, 0, 0, 0, 0, 0),
}
SINCE_APRIL_20 = {"Alice": (3, 1, 1, 1), "Bob": (3, 2, 1, 0), "Charlie": (3, 2, 0, 0), "Diana": (0, 0, 0, 0)}


@pytest.fixture
def demo(frame):
    now = "timestamp'2024-01-15 10:00:00'"
    postgres = frame("id int, name string, email string", *CUSTOMERS).selectExpr("*", f"{now} as created_at")
    orders = frame("id int, customer_id int, amount int", *ORDERS).selectExpr(
        "id", "customer_id", "cast(amount as decimal(10,2)) as amount", "'completed' as status", f"{now} as created_at"
    )
    events = frame("id bigint, user_id bigint, event_type string, day string", *EVENTS).selectExpr(
        "id", "user_id", "event_type", "'/' as page_url", "cast(day as timestamp) as created_at"
    )
    return {
        "customers": models.customers(
            models.stg_postgres_customers(postgres),
            models.stg_seed_customers(frame("id bigint, name string, email string", *CUSTOMERS[:3])),
        ),
        "events": models.stg_clickhouse_events(events),
        "orders": models.stg_postgres_orders(orders),
        "seed_orders": models.stg_seed_orders(frame("id bigint, customer_id bigint, amount bigint", *SEED_ORDERS)),
    }


STRIPE = {
    "customers": "id string, email string, name string, currency string, livemode boolean, created bigint",
    "charges": "id string, customer string, amount bigint, amount_refunded bigint, currency string, "
    "status string, paid boolean, captured boolean, refunded boolean, disputed boolean, created bigint",
    "subscriptions": "id string, customer string, status string, currency string, "
    "cancel_at_period_end boolean, created bigint, start_date bigint, canceled_at bigint, ended_at string",
}


def _activity(demo, frame, customers=(), charges=(), subscriptions=(), events=None):
    return models.customer_activity(
        demo["customers"],
        demo["events"] if events is None else events,
        demo["orders"],
        demo["seed_orders"],
        models.stg_stripe_customers(frame(STRIPE["customers"], *customers)),
        models.stg_stripe_charges(frame(STRIPE["charges"], *charges)),
        models.stg_stripe_subscriptions(frame(STRIPE["subscriptions"], *subscriptions)),
    )


def test_activity_without_billing(demo, frame):
    found = {
        r["customer_id"]: (
            r["name"], r["customer_source"], r["order_count"], r["total_spent"],
            r["event_count"], r["page_views"], r["clicks"], r["purchases"],
        )
        for r in _activity(demo, frame).collect()
    }
    assert found == EXPECTED


def test_activity_from_the_declared_cursor_on(demo, frame):
    late = demo["events"].filter("created_at > '2026-04-20'")
    found = {
        r["name"]: (r["event_count"], r["page_views"], r["clicks"], r["purchases"])
        for r in _activity(demo, frame, events=late).filter("customer_source = 'postgres'").collect()
    }
    assert found == SINCE_APRIL_20


def test_activity_with_billing(demo, frame):
    """An address shared by two sources shows its billing on both; unknown or unaddressed payers are left out."""
    customers = [
        ("cus_1", "alice@example.com", "A", "usd", True, 1),
        ("cus_2", "alice@example.com", "A again", "usd", True, 1),
        ("cus_3", None, "nobody", "usd", True, 1),
        ("cus_4", "diana@example.com", "D", "usd", True, 1),
    ]
    charge = lambda id, who, cents, back, paid, at: (id, who, cents, back, "usd", "s", paid, paid, False, False, at)
    charges = [
        charge("c1", "cus_1", 100, 0, True, 10),
        charge("c2", "cus_1", 200, 50, False, 20),
        charge("c3", "cus_2", 400, 0, True, 15),
        charge("c4", "cus_3", 800, 0, True, 15),
        charge("c5", "cus_9", 1600, 0, True, 15),
    ]
    subscriptions = [
        ("s1", "cus_1", "active", "usd", False, 30, 31, None, None),
        ("s2", "cus_1", "canceled", "usd", False, 40, 41, 42, "43"),
        ("s3", "cus_4", "active", "usd", False, 50, 51, None, None),
    ]
    names = [
        "name", "customer_source", "stripe_charge_count", "stripe_paid_cents", "stripe_refunded_cents",
        "stripe_subscription_count", "active_stripe_subscriptions",
        "unix_seconds(last_stripe_charge_at)", "unix_seconds(last_stripe_subscription_at)",
    ]
    found = {tuple(r) for r in _activity(demo, frame, customers, charges, subscriptions).selectExpr(*names).collect()}
    assert found == {
        ("Alice", "postgres", 3, 500, 50, 2, 1, 20, 40),
        ("Alice", "seed", 3, 500, 50, 2, 1, 20, 40),
        ("Diana", "postgres", 0, 0, 0, 1, 1, None, 50),
        ("Bob", "postgres", 0, 0, 0, 0, 0, None, None),
        ("Bob", "seed", 0, 0, 0, 0, 0, None, None),
        ("Charlie", "postgres", 0, 0, 0, 0, 0, None, None),
        ("Charlie", "seed", 0, 0, 0, 0, 0, None, None),
    }


def test_order_counts_leave_seed_customers_at_zero(demo, rows):
    found = models.customer_order_counts(demo["customers"], demo["orders"])
    assert rows(found.filter("total_amount = 0"), "name", "order_count") == [("Alice", 0), ("Bob", 0), ("Charlie", 0)]
    assert rows(found.filter("total_amount > 0"), "name", "order_count", "total_amount") == [
        ("Alice", 2, Decimal("150.00")), ("Bob", 3, Decimal("400.00")),
        ("Charlie", 1, Decimal("300.00")), ("Diana", 1, Decimal("50.00")),
    ]


def test_null_keys_match_nothing(demo, frame):
    nobody = frame("id int, customer_id int, amount int", (1, None, 5)).selectExpr(
        "id", "customer_id", "cast(amount as decimal(10,2)) as amount", "'x' as status", "timestamp'2024-01-01' as created_at"
    )
    found = models.customer_order_counts(demo["customers"], demo["orders"].unionByName(nobody))
    assert found.selectExpr("sum(order_count)").first()[0] == 7


def test_epochs(frame):
    raw = frame(STRIPE["subscriptions"], ("s", "c", "active", "usd", False, 0, 86400, None, "60"))
    row = models.stg_stripe_subscriptions(raw).selectExpr(
        "cast(created_at as string)", "cast(started_at as string)", "canceled_at", "cast(ended_at as string)"
    )
    assert row.first() == ("1970-01-01 00:00:00", "1970-01-02 00:00:00", None, "1970-01-01 00:01:00")
