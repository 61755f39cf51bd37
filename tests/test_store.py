"""Load strategies and materializations, the untested corners of the originals included."""

import pytest

from quarrymill.operators.upsert import DuplicateKeyError, require_unique
from quarrymill.sinks import store as sinks

PAIR = "id string, name string"


def test_three_strategies(store, frame, rows):
    sinks.write_replace(store, "u", frame(PAIR, ("1", "a")))
    assert sinks.write_append(store, "u", frame(PAIR, ("2", "b"))).rows == 1
    sinks.write_merge(store, "u", frame(PAIR, ("1", "a2")), "id")
    assert rows(store.table("u")) == [("1", "a2"), ("2", "b")]


def test_replace_with_nothing_leaves_an_empty_table(store, frame):
    sinks.write_replace(store, "u", frame(PAIR, ("1", "a")))
    assert sinks.write_replace(store, "u", frame(PAIR)).rows == 0
    assert store.table("u").columns == ["id", "name"] and store.table("u").isEmpty()


def test_append_fills_and_refuses_columns(store, frame, rows):
    sinks.write_append(store, "u", frame(PAIR, ("1", "a")))
    sinks.write_append(store, "u", frame("id string", ("2",)))
    assert rows(store.table("u")) == [("1", "a"), ("2", None)]
    with pytest.raises(ValueError, match="'extra'"):
        sinks.write_append(store, "u", frame("id string, extra int", ("3", 1)))


def test_append_finds_columns_by_name(store, frame, rows):
    sinks.write_append(store, "u", frame(PAIR, ("1", "a")))
    sinks.write_append(store, "u", frame("name string, id string", ("b", "2")))
    assert rows(store.table("u"), "id", "name") == [("1", "a"), ("2", "b")]


def test_merge_duplicate_in_one_batch_fails_and_changes_nothing(store, frame, rows):
    sinks.write_merge(store, "u", frame(PAIR, ("1", "a")), "id")
    with pytest.raises(DuplicateKeyError):
        sinks.write_merge(store, "u", frame(PAIR, ("2", "x"), ("2", "y")), "id")
    assert rows(store.table("u")) == [("1", "a")]
    assert not [t for t in store.spark.catalog.listTables(store.database) if "__stg" in t.name]


def test_merge_last_extract_wins(store, frame, rows):
    extracts = frame("id int, name string, n int", (1, "a", 1), (1, "b", 2), (2, "c", 1), (None, "d", 1), (None, "d", 1))
    sinks.write_merge(store, "u", extracts, "id", seq="n")
    assert rows(store.table("u")) == [(1, "b", 2), (2, "c", 1), (None, "d", 1), (None, "d", 1)]
    with pytest.raises(DuplicateKeyError):
        sinks.write_merge(store, "u", frame("id int, name string, n int", (3, "x", 1), (3, "y", 1)), "id", seq="n")


def test_merge_null_keys_are_appended(store, frame, rows):
    for name in "ab":
        sinks.write_merge(store, "u", frame("id int, name string", (None, name), (1, name)), "id")
    assert rows(store.table("u")) == [(1, "b"), (None, "a"), (None, "b")]


def test_merge_updates_to_null(store, frame, rows):
    sinks.write_merge(store, "u", frame(PAIR, ("1", "a")), "id")
    sinks.write_merge(store, "u", frame(PAIR, ("1", None)), "id")
    assert rows(store.table("u")) == [("1", None)]


def test_merge_of_keys_only(store, frame, rows):
    for ids in (("1",), ("2",)), (("2",), ("3",)):
        sinks.write_merge(store, "u", frame("id string", *ids), "id")
    assert rows(store.table("u")) == [("1",), ("2",), ("3",)]


def test_merge_into_duplicated_target_fails(store, frame):
    sinks.write_replace(store, "u", frame(PAIR, ("1", "a"), ("1", "b")))
    with pytest.raises(DuplicateKeyError, match="existing"):
        sinks.write_merge(store, "u", frame(PAIR, ("1", "c")), "id")
    # Keys the rows do not have are left to an explicit check of the whole table.
    sinks.write_merge(store, "u", frame(PAIR, ("2", "c")), "id")
    with pytest.raises(DuplicateKeyError):
        require_unique(store.table("u"), "id", "u")


def test_merge_checks_the_target_again_after_an_append(store, frame):
    sinks.write_merge(store, "u", frame(PAIR, ("1", "a")), "id")
    sinks.write_append(store, "u", frame(PAIR, ("1", "b")))
    with pytest.raises(DuplicateKeyError, match="existing"):
        sinks.write_merge(store, "u", frame(PAIR, ("1", "c")), "id")


def test_composite_key_is_refused(store, frame):
    with pytest.raises(ValueError, match="exactly one"):
        sinks.write_merge(store, "u", frame(PAIR, ("1", "a")), ["id", "name"])


def test_merge_keeps_columns_the_batch_lacks(store, frame, rows):
    sinks.write_merge(store, "u", frame("id int, a string, b string", (1, "a", "b"), (2, "a", "b")), "id")
    sinks.write_merge(store, "u", frame("id int, a string", (1, "x"), (3, "y"), (None, "z")), "id")
    assert rows(store.table("u")) == [(1, "x", "b"), (2, "a", "b"), (3, "y", None), (None, "z", None)]


def test_incremental(store, frame, rows):
    sinks.publish_incremental(store, "m", frame(PAIR, ("1", "a")), "id")
    sinks.publish_incremental(store, "m", frame(PAIR, ("1", "a2"), ("2", "b")), "id")
    sinks.publish_incremental(store, "m", frame(PAIR, ("2", "b2")), "id")
    assert rows(store.table("m")) == [("1", "a2"), ("2", "b2")]
    with pytest.raises(ValueError, match="m: incremental requires unique_key"):
        sinks.publish_incremental(store, "m", frame(PAIR), None)
    with pytest.raises(ValueError, match="'more'"):
        sinks.publish_incremental(store, "m", frame("id string, more int", ("1", 1)), "id")
    with pytest.raises(DuplicateKeyError):
        sinks.publish_incremental(store, "m", frame(PAIR, ("9", "a"), ("9", "b")), "id")


def test_incremental_runs_again_after_a_failure(store, frame, rows):
    broken = frame(PAIR, ("1", "x")).selectExpr("id", "raise_error('boom') as name")
    with pytest.raises(Exception, match="boom"):
        sinks.publish_incremental(store, "m", broken, "id")
    sinks.publish_incremental(store, "m", frame(PAIR, ("1", "a")), "id")
    assert rows(store.table("m")) == [("1", "a")]


def test_republish_leaves_one_table_and_dependent_views(store, frame, rows):
    sinks.publish_table(store, "m", frame("id int", (1,)))
    sinks.publish_view(store, "v", f"select id + 10 as id from {store.name('m')}")
    sinks.publish_table(store, "m", frame("id int", (2,)))
    sinks.drop_superseded(store, "m")
    assert rows(store.table("m")) == [(2,)] and rows(store.table("v")) == [(12,)]
    assert len(store.versions("m")) == 1


def test_a_failed_publish_leaves_the_old_rows(store, frame, rows):
    sinks.publish_table(store, "m", frame("id int", (1,)))
    with pytest.raises(Exception, match="boom"):
        sinks.publish_table(store, "m", frame("id int", (1,)).selectExpr("raise_error('boom') as id"))
    assert rows(store.table("m")) == [(1,)]


def test_schema_may_change_between_versions(store, frame):
    sinks.publish_table(store, "m", frame("id int", (1,)))
    sinks.publish_table(store, "m", frame("id string, more int", ("a", 1)))
    assert store.table("m").dtypes == [("id", "string"), ("more", "int")]


def test_compact_keeps_rows_and_key(store, frame, rows):
    sinks.write_merge(store, "u", frame(PAIR, ("1", "a"), ("2", "b")), "id")
    sinks.compact(store, "u")
    assert rows(store.table("u")) == [("1", "a"), ("2", "b")]
    assert store.properties("u")["quarrymill.unique_key"] == "id"


def test_loading_into_a_plain_view_is_refused(store, frame):
    sinks.publish_view(store, "v", "select 1 as id")
    with pytest.raises(ValueError, match="plain view"):
        sinks.write_append(store, "v", frame("id int", (2,)))


def test_typed_create(store):
    sinks.typed_create(store, "t", {"a": "bigint", "b": None, "c": "numeric(10,2)", "d": "timestamptz"})
    assert store.table("t").dtypes == [
        ("a", "bigint"), ("b", "string"), ("c", "decimal(10,2)"), ("d", "timestamp"),
    ]
    sinks.typed_create(store, "t", {"other": None})
    assert store.table("t").columns == ["a", "b", "c", "d"]


def test_preview_is_ten_rows_unless_told(store, spark):
    sinks.publish_table(store, "m", spark.range(50))
    assert sinks.preview(store, "m").count() == 10
    assert sinks.preview(store, "m", 3, order_by=["id"]).collect() == [(0,), (1,), (2,)]


NUMBERED = "id int, name string"


def _hundred(store, frame):
    sinks.write_merge(store, "u", frame(NUMBERED, *[(i, "old") for i in range(100)], (None, "none")), "id")
    return store.properties("u")["quarrymill.current"]


def test_a_merge_kept_apart_leaves_the_large_table_alone(store, frame, rows):
    before = _hundred(store, frame)
    sinks.write_merge(store, "u", frame(NUMBERED, (3, "new"), (200, "new"), (None, "more")), "id", apart=True)
    sinks.write_merge(store, "u", frame(NUMBERED, (3, "newer"), (4, "new"), (None, "most")), "id", apart=True)
    assert store.properties("u")["quarrymill.current"] == before
    found = rows(store.table("u"))
    assert len(found) == 104
    assert [r for r in found if r[1] != "old"] == [
        (200, "new"), (3, "newer"), (4, "new"), (None, "more"), (None, "most"), (None, "none"),
    ]
    plan = store.table("u")._jdf.queryExecution()
    assert "LeftAnti" in plan.executedPlan().toString() and "broadcast" not in plan.analyzed().toString()
    sinks.drop_superseded(store, "u")
    assert len(store.versions("u")) == 2 and len(rows(store.table("u"))) == 104


def test_a_merge_folds_in_unless_asked(store, frame, rows):
    _hundred(store, frame)
    sinks.write_merge(store, "u", frame(NUMBERED, (3, "new")), "id", apart=True)
    sinks.write_merge(store, "u", frame(NUMBERED, (4, "new")), "id")
    assert "quarrymill.changes" not in store.properties("u")
    assert store.table("u").filter("name = 'new'").count() == 2 and store.table("u").count() == 101


@pytest.mark.parametrize("apart", [True, False])
def test_changes_keep_columns_the_batch_lacks(store, frame, rows, apart):
    _hundred(store, frame)
    sinks.write_merge(store, "u", frame("id int", (5,), (300,)), "id", apart=apart)
    assert rows(store.table("u").filter("id in (5, 300)")) == [(300, None), (5, "old")]


def test_append_and_compact_after_changes(store, frame, rows):
    _hundred(store, frame)
    sinks.write_merge(store, "u", frame(NUMBERED, (3, "new")), "id", apart=True)
    sinks.write_append(store, "u", frame(NUMBERED, (3, "again")))
    assert rows(store.table("u").filter("id = 3")) == [(3, "again"), (3, "new")]
    with pytest.raises(DuplicateKeyError, match="existing"):
        sinks.write_merge(store, "u", frame(NUMBERED, (3, "newer")), "id")
    sinks.write_merge(store, "u", frame(NUMBERED, (4, "new")), "id")
    assert rows(store.table("u").filter("id = 4")) == [(4, "new")]


def test_merge_by_another_key_after_changes(store, frame, rows):
    sinks.write_merge(store, "u", frame("a int, b int", *[(i, i) for i in range(100)]), "a")
    sinks.write_merge(store, "u", frame("a int, b int", (1, 1000)), "a", apart=True)
    with pytest.raises(ValueError, match="compact"):
        sinks.write_merge(store, "u", frame("a int, b int", (5000, 1000)), "b", apart=True)
    sinks.write_merge(store, "u", frame("a int, b int", (5000, 1000)), "b")
    assert rows(store.table("u").filter("a > 99 or b > 99")) == [(5000, 1000)]
    assert store.table("u").count() == 100


def test_sequences_count_across_merges(store, frame, rows):
    schema = "id int, name string, n int"
    for apart in (False, True):
        table = f"u{int(apart)}"
        sinks.write_merge(store, table, frame(schema, (1, "new", 9), (2, "b", None), (None, "x", 1)), "id", "n")
        sinks.write_merge(
            store, table, frame(schema, (1, "old", 5), (2, "c", None), (3, "d", 1), (None, "x", 1)), "id", "n", apart=apart
        )
        sinks.write_merge(store, table, frame(schema, (1, "same", 9), (2, "e", 0), (3, "f", None)), "id", "n", apart=apart)
        assert rows(store.table(table)) == [
            (1, "same", 9), (2, "e", 0), (3, "d", 1), (None, "x", 1), (None, "x", 1),
        ]


def test_landed_batches_are_skipped(store, frame, rows):
    sinks.write_append(store, "u", frame(PAIR, ("1", "a")))
    for _ in range(2):
        assert sinks.write_append(store, "u", frame(PAIR, ("2", "b")), batch=("q", 0)).rows in (0, 1)
        sinks.write_merge(store, "u", frame(PAIR, ("1", "c"), (None, "n")), "id", batch=("q", 1))
    sinks.compact(store, "u")
    assert sinks.write_append(store, "u", frame(PAIR, ("2", "b")), batch=("q", 1)).rows == 0
    assert rows(store.table("u")) == [("1", "c"), ("2", "b"), (None, "n")]


def test_readers_of_a_version_are_not_disturbed_by_appends(store, frame, rows):
    sinks.write_append(store, "u", frame(PAIR, ("1", "a")))
    before = store.table(store.properties("u")["quarrymill.current"])
    sinks.write_append(store, "u", frame(PAIR, ("2", "b")))
    assert before.count() == 1 and store.table("u").count() == 2


def test_three_replaces_leave_one_old_version(store, frame, rows):
    for k in range(3):
        sinks.write_replace(store, "u", frame("id int", (k,)))
    assert len(store.versions("u")) == 2 and rows(store.table("u")) == [(2,)]


def test_a_merge_into_a_plain_view_leaves_nothing(store, frame):
    sinks.publish_view(store, "v", "select '1' as id, 'a' as name")
    with pytest.raises(ValueError, match="plain view"):
        sinks.write_merge(store, "v", frame(PAIR, ("2", "b")), "id")
    assert store.versions("v") == []
    with pytest.raises(TypeError, match="SQL text"):
        sinks.publish_view(store, "w", frame(PAIR))


def test_a_merge_shuffles_no_whole_key_column(store, spark, conf):
    """The check of stored keys reads those of the rows only."""
    from quarrymill.operators.upsert import key_facts, touched

    sinks.write_append(store, "u", spark.range(20000).selectExpr("id", "id as v"))
    updates = spark.range(500, 505).selectExpr("id", "-id as v")
    plan = touched(store.table("u"), updates, "id", key_facts(updates, "id"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,500)" in plan and "LessThanOrEqual(id,504)" in plan


@pytest.mark.parametrize("apart", [True, False])
def test_random_merges_agree_with_a_dict(store, frame, apart):
    """The key is the last column; column order must survive every way to merge."""
    import random

    draw = random.Random(11)
    expected, extra = {}, 0
    for step in range(6):
        keys = draw.sample(range(400), 200 if step == 0 else draw.choice([3, 8, 60]))
        batch = [(f"s{step}", step, k) for k in keys] + [("n", step, None)]
        sinks.write_merge(store, "u", frame("name string, step int, id int", *batch), "id", apart=apart)
        expected |= {k: f"s{step}" for k in keys}
        extra += 1
    found = store.table("u").collect()
    assert {r["id"]: r["name"] for r in found if r["id"] is not None} == expected
    assert len(found) == len(expected) + extra


def test_keys_with_odd_names(store, frame, rows):
    schema = "`it's a.key` int, name string"
    sinks.write_merge(store, "u", frame(schema, *[(i, "old") for i in range(50)]), "it's a.key")
    sinks.write_merge(store, "u", frame(schema, (7, "new")), "it's a.key", apart=True)
    assert "quarrymill.changes" in store.properties("u")
    assert rows(store.table("u").filter("name = 'new'")) == [(7, "new")] and store.table("u").count() == 50


def test_a_null_sequence_comes_first(store, frame, rows):
    schema = "id int, name string, n int"
    sinks.write_merge(store, "u", frame(schema, (1, "a", None), (1, "b", 1), (2, "c", None)), "id", seq="n")
    assert rows(store.table("u")) == [(1, "b", 1), (2, "c", None)]


def test_sorted_compaction_gives_disjoint_files(store, spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    shuffled = spark.range(4000).selectExpr("if(id % 3 = 0, null, (id * 7919) % 4001) as id", "id as v")
    sinks.write_append(store, "u", shuffled)
    sinks.compact(store, "u", sort_by="id")
    current = store.table(store.properties("u")["quarrymill.current"])
    files = (
        current.groupBy("_metadata.file_name")
        .agg({"id": "min", "*": "count"})
        .withColumnRenamed("min(id)", "low")
        .join(current.groupBy("_metadata.file_name").agg({"id": "max"}), "file_name")
        .collect()
    )
    spans = sorted((f["low"], f["max(id)"]) for f in files if f["low"] is not None)
    assert all(one[1] <= two[0] for one, two in zip(spans, spans[1:])) and len(spans) > 3
    assert max(f["count(1)"] for f in files) < 2000 and store.table("u").count() == 4000


def test_tables_with_similar_names_are_left_alone(store, frame, rows):
    sinks.publish_table(store, "a", frame("id int", (1,)))
    sinks.publish_table(store, "a__c", frame("id int", (2,)))
    sinks.publish_table(store, "a", frame("id int", (3,)))
    assert len(sinks.drop_superseded(store, "a")) == 1
    assert rows(store.table("a")) == [(3,)] and rows(store.table("a__c")) == [(2,)]


def test_an_empty_merge_changes_nothing(store, frame, rows):
    _hundred(store, frame)
    before = store.properties("u")
    assert sinks.write_merge(store, "u", frame(NUMBERED), "id").rows == 0
    assert store.properties("u") == before and store.table("u").count() == 101
    with pytest.raises(ValueError, match="'other'"):
        sinks.write_merge(store, "u", frame("id int, other int"), "id")
    assert sinks.write_merge(store, "w", frame(NUMBERED), "id").rows == 0
    sinks.write_merge(store, "w", frame(NUMBERED, (1, "a")), "id")
    assert rows(store.table("w")) == [(1, "a")]


@pytest.mark.parametrize("broadcast", [True, False])
def test_keys_are_compared_as_the_tables_type(store, frame, rows, conf, broadcast):
    if not broadcast:
        conf(spark__sql__autoBroadcastJoinThreshold="-1")
    sinks.write_merge(store, "u", frame("id bigint, name string", *[(i, "old") for i in range(8, 12)]), "id")
    sinks.write_merge(store, "u", frame(PAIR, ("9", "new"), ("010", "new")), "id")
    assert rows(store.table("u")) == [(10, "new"), (11, "old"), (8, "old"), (9, "new")]
    with pytest.raises(DuplicateKeyError):
        sinks.write_merge(store, "u", frame(PAIR, ("9", "x"), ("09", "y")), "id")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(20,3)", "double", "binary", "string"])
def test_keys_of_every_type(store, spark, rows, kind):
    made = {
        "timestamp": "timestamp_micros(id * 3600000001)",
        "timestamp_ntz": "cast(timestamp_micros(id * 3600000001) as timestamp_ntz)",
        "date": "date_add(date'2024-01-01', cast(id as int))",
        "binary": "cast(cast(id as string) as binary)",
        "double": "id / 3d",
    }.get(kind, f"cast(id as {kind})")
    sinks.write_merge(store, "u", spark.range(40).selectExpr(f"{made} as k", "'old' as name"), "k")
    sinks.write_merge(store, "u", spark.range(9, 25).selectExpr(f"{made} as k", "'new' as name"), "k")
    assert rows(store.table("u").groupBy("name").count()) == [("new", 16), ("old", 24)]


def test_an_append_after_changes_kept_apart_writes_its_rows_only(store, frame, rows):
    sinks.write_merge(store, "u", frame(NUMBERED, *[(i, "old") for i in range(100)]), "id")
    sinks.write_merge(store, "u", frame(NUMBERED, (3, "new"), (5, "new")), "id", apart=True)
    before = set(store.versions("u"))
    assert sinks.write_append(store, "u", frame(NUMBERED, (3, "added"), (200, "added"))).rows == 2
    (part,) = set(store.versions("u")) - before
    assert store.table(part).count() == 2 and before <= set(store.versions("u"))
    found = rows(store.table("u").filter("id in (3, 5, 200)"))
    assert sorted(found) == [(3, "added"), (3, "new"), (5, "new"), (200, "added")]
    sinks.write_merge(store, "u", frame(NUMBERED, (200, "merged"), (7, "merged")), "id", apart=True)
    assert sorted(rows(store.table("u").filter("id in (3, 5, 7, 200)"))) == [
        (3, "added"), (3, "new"), (5, "new"), (7, "merged"), (200, "merged")
    ]
    assert store.table("u").count() == 102
    sinks.compact(store, "u")
    assert store.table("u").count() == 102


def test_many_appends_leave_few_parts(store, frame, rows, monkeypatch):
    monkeypatch.setattr(sinks, "FOLDED_PARTS", 3)
    for n in range(14):
        sinks.write_append(store, "u", frame("id int, n int", (n, n), (n, None)))
    marks = sinks._marks(store, "u")
    # 14 is 112 to the base of three.
    assert marks[sinks._TIERS] == "2,1,0,0" and len(sinks._parts(marks)) == 4
    assert rows(store.table("u")) == sorted([(n, n) for n in range(14)] + [(n, None) for n in range(14)], key=repr)
    assert len(store.versions("u")) <= 4 + sinks.GRACE_VERSIONS + 3
