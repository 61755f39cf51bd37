"""Plans at scale: what is shuffled, what reaches the scan, and whether hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

from quarrymill.operators.skew import own_shuffle
from quarrymill.operators.upsert import key_facts, upsert
from quarrymill.plans import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_hot_key_is_split_at_run_time(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="128k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    )
    customers = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 3 = 0, null, if(id % 3 = 1, 'info@example.com', concat(id, '@example.com'))) as email",
        "md5(cast(id as string)) as payload",
    )
    billing = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id = 0, 'info@example.com', concat(id, '@example.com')) as email", "id as cents"
    ).groupBy("email").sum("cents")

    split = customers.join(own_shuffle(billing, "email"), "email", "left")
    assert split.count() == 60_000
    joined = split.selectExpr("count(*)", "count(`sum(cents)`)", "max(payload)")
    assert joined.collect()[0][:2] == (60_000, 40_000)
    assert "skew=true" in plan_of(joined)


def test_flagship_shuffles_each_fact_once_and_as_partial_sums(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = plan_of(QUERIES["customer_activity"](spark, SF_DIR))
    # md5 runs on customers and on aggregated rows, never in a filter on the facts.
    assert not re.search(r"Filter .*md5", plan)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?Location: \S+ \S+?(\w+)\.parquet", plan)
    columns = {table: names for names, table in scans}
    assert "l_comment" not in columns["lineitem"]
    # Above every fact scan the first shuffle comes after a partial aggregation.
    for block in plan.split("Exchange hashpartitioning")[1:]:
        below = block.split("FileScan")[0]
        if "lineitem.parquet" in block.split("Exchange")[0] or "orders.parquet" in block.split("Exchange")[0]:
            assert "partial_" in below


def test_few_update_keys_are_broadcast_and_the_base_is_not_shuffled(spark):
    base = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    updates = base.filter("o_orderkey between 100 and 120")
    plan = plan_of(upsert(base, updates, "o_orderkey", key_facts(updates, "o_orderkey")))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert plan.count("FileScan") == 4  # the base within and beyond the key range, the keys and the updates


def test_many_update_keys_meet_only_their_range_of_the_base(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    base = orders.withColumn("o_orderkey", F.expr("if(o_orderkey % 4 = 0, null, o_orderkey)"))
    stored = orders.select("o_orderkey", "o_custkey")
    updates = stored.filter("o_orderkey between 100 and 120")
    facts = key_facts(updates, "o_orderkey")
    plan = plan_of(upsert(stored, updates, "o_orderkey", facts))
    assert "GreaterThanOrEqual(o_orderkey,100)" in plan and "LessThanOrEqual(o_orderkey,120)" in plan
    assert "Or(Or(IsNull(o_orderkey),LessThan(o_orderkey,100)),GreaterThan(o_orderkey,120))" in plan
    assert "SortMergeJoin" in plan and "Broadcast" not in plan

    merged = upsert(base, updates.withColumn("o_custkey", F.lit(-1)), "o_orderkey", facts)
    assert merged.count() == base.count() + updates.filter("o_orderkey % 4 = 0").count()
    assert merged.filter("o_custkey = -1").count() == updates.count()
    # Columns the updates lack come from the base rows they replace.
    assert merged.filter("o_custkey = -1 and o_orderstatus is null").count() == 6


def test_all_unique_checks_of_a_table_share_one_shuffle(spark):
    plan = plan_of(QUERIES["test_unique"](spark, SF_DIR))
    assert plan.count("FileScan") == 1 and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["filter_eq", "scan_cursor", "keyset_page"])
def test_filters_reach_the_scan(spark, name):
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", plan_of(QUERIES[name](spark, SF_DIR)))[1]
    assert re.search(r"EqualTo|GreaterThan", pushed)


def test_no_query_has_a_cross_join(spark):
    for name in ("join_on_true", "filter_gt_max", "customer_activity", "graph_descendants"):
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
