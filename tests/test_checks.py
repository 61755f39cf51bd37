"""Column tests and lineage."""

import pytest

from quarrymill.operators import lineage, quality
from quarrymill.operators.quality import TestedModel, run_column_tests


def test_three_results_and_null_failures(spark, frame, rows):
    df = frame("id int, email string", (None, "a"), (None, "b"), (None, "b"), (1, "c"))
    model = TestedModel("m", df, {"id": ["unique", "not_null"], "email": ["not_null", "unique"]})
    results = run_column_tests(spark, [model])
    assert rows(results, "column", "test", "status", "failures") == [
        ("email", "not_null", "pass", 0),
        ("email", "unique", "fail", 1),
        ("id", "not_null", "fail", 3),
        ("id", "unique", "pass", 0),
    ]
    assert not quality.all_passed(results)
    assert quality.all_passed(run_column_tests(spark, [TestedModel("m", df, {"email": ["not_null"]})]))


def test_unique_counts_values_not_rows(frame, rows):
    df = frame("v string", ("a",), ("a",), ("a",), ("b",), ("b",), ("c",), (None,), (None,))
    assert rows(quality.column_test_counts(df, {"v": ["unique"]})) == [("v", "unique", 2)]


def test_unique_counts_many_columns_at_once(frame, rows):
    df = frame("a int, b string, c double", (1, "x", 0.5), (1, "y", 0.5), (2, "y", 1.5), (2, "z", None))
    found = quality.column_test_counts(df, {"a": ["unique"], "b": ["unique"], "c": ["unique", "not_null"]})
    assert rows(found) == [("a", "unique", 2), ("b", "unique", 1), ("c", "not_null", 1), ("c", "unique", 1)]


def test_unique_of_very_many_columns(spark, rows):
    wide = spark.range(3).selectExpr(*[f"if({i} % 2 = 0, id, 0) as c{i}" for i in range(70)])
    found = quality.column_test_counts(wide, {f"c{i}": ["unique"] for i in range(70)})
    assert {r["column"]: r["failures"] for r in found.collect()} == {f"c{i}": i % 2 for i in range(70)}


def test_of_an_empty_table_passes(frame, rows):
    df = frame("a int")
    assert rows(quality.column_test_counts(df, {"a": ["unique", "not_null"]})) == [
        ("a", "not_null", 0), ("a", "unique", 0),
    ]


def test_errors_do_not_stop_the_rest(spark, frame, rows):
    good = frame("id int", (1,))
    broken = good.selectExpr("id", "cast('x' || id as int) as bad")
    results = run_column_tests(
        spark,
        [
            TestedModel("m", broken, {"id": ["unique"], "bad": ["not_null"], "gone": ["unique"]}),
            TestedModel("n", good, {"id": ["not_null"]}),
            TestedModel("untested", good, {}),
        ],
    )
    assert rows(results, "model", "column", "status") == [
        ("m", "bad", "error"), ("m", "gone", "error"), ("m", "id", "pass"), ("n", "id", "pass"),
    ]
    assert results.filter("status = 'error' and error is null").isEmpty()


def test_unknown_tests_are_refused(spark, frame):
    with pytest.raises(ValueError, match="accepted_values"):
        run_column_tests(spark, [TestedModel("m", frame("id int", (1,)), {"id": ["accepted_values"]})])


EDGE = "upstream string, downstream string"


@pytest.fixture
def chain(frame):
    return frame(EDGE, ("a", "b"), ("b", "c"))


@pytest.fixture
def chain_nodes(frame):
    return frame(
        "id string, path string, materialized string, tags array<string>",
        ("a", "models/a.sql", "view", None), ("b", "models/mart/b.sql", "table", []),
        ("c", "models/mart/c.sql", "table", ["nightly"]),
    )


def test_selectors(chain, chain_nodes, rows):
    def ids(method, value):
        return lineage.select_nodes(chain_nodes, method, value)

    up_c = lineage.graph_ancestors(chain, ids("id", "c"))
    assert rows(up_c) == [("a",), ("b",), ("c",)]
    assert rows(lineage.graph_descendants(chain, ids("id", "a"))) == [("a",), ("b",), ("c",)]
    assert rows(lineage.graph_descendants(chain, ids("id", "c"))) == [("c",)]
    assert rows(ids("tag", "nightly")) == [("c",)]
    assert rows(ids("path", "mart/")) == [("b",), ("c",)]
    assert rows(ids("config.materialized", "view")) == [("a",)]
    assert rows(ids("owner", "b")) == [("b",)]
    assert rows(lineage.set_union(ids("id", "a"), ids("id", "b"))) == [("a",), ("b",)]
    assert rows(lineage.set_intersect(up_c, ids("tag", "nightly"))) == [("c",)]
    assert rows(lineage.set_intersect(ids("id", "a"), ids("id", "b"))) == []


def test_cycles_end_and_nothing_reaches_nothing(frame, rows):
    loop = frame(EDGE, ("a", "b"), ("b", "c"), ("c", "a"), ("x", "y"), ("y", None))
    assert rows(lineage.graph_descendants(loop, frame("id string", ("b",)))) == [("a",), ("b",), ("c",)]
    assert rows(lineage.graph_descendants(loop, frame("id string", ("x",)))) == [("x",), ("y",)]
    assert rows(lineage.graph_descendants(loop, frame("id string"))) == []


def test_reach_agrees_with_brute_force(spark, frame, rows):
    import random

    draw = random.Random(5)
    pairs = [(f"n{draw.randrange(60)}", f"n{draw.randrange(60)}") for _ in range(70)]
    reached, front = {"n1", "n2"}, {"n1", "n2"}
    while front:
        front = {d for u, d in pairs if u in front} - reached
        reached |= front
    found = lineage.graph_descendants(frame(EDGE, *pairs), frame("id string", ("n1",), ("n2",), ("n1",)))
    assert {r["id"] for r in found.collect()} == reached and found.count() == len(reached)


def test_dangling_and_duplicates(chain, chain_nodes, frame, rows):
    more = chain.unionByName(frame(EDGE, ("missing", "c"), ("missing", "c")))
    assert rows(lineage.dangling_refs(more, chain_nodes)) == [("missing", "c")]
    twice = chain_nodes.unionByName(chain_nodes.filter("id = 'b'"))
    assert rows(quality.duplicate_ids(twice, "id")) == [("b", 2)]
