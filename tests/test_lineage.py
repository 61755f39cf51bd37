"""Reachability in deep graphs."""

import random
from pathlib import Path

import pytest

from quarrymill.operators import lineage
from quarrymill.session import shared_dir


def _reached(pairs, start):
    found, front = set(start), set(start)
    while front:
        front = {d for u, d in pairs if u in front} - found
        found |= front
    return found


def _folders(spark):
    return set(Path(shared_dir(spark)).glob("reach_*/*"))


@pytest.mark.parametrize("seed", [1])
def test_contraction_agrees_with_brute_force(spark, frame, monkeypatch, seed):
    """Chains, trees, cycles, loops, repeated edges and parts that nothing leads to, contracted after every level."""
    rng = random.Random(seed)
    monkeypatch.setattr(lineage, "_LEVELS_APART", 3)
    pairs = [(i, i + 1) for i in range(40)] + [(i, 500 + i) for i in range(0, 40, 3)]
    pairs += [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(25)]
    pairs += [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(200, 200), (300, 301), (301, 302), (302, 20)]
    pairs += [(rng.randint(0, 60), 400), (400, 401), (401, 402), (402, 401), (402, 403)] + pairs[:5]
    start = rng.sample(range(60), 2)
    edges = frame("upstream long, downstream long", *pairs, (None, 1), (1, None))
    found = lineage.graph_descendants(edges, frame("id long", *[(s,) for s in start]))
    ids = [r["id"] for r in found.collect()]
    assert sorted(ids) == sorted(_reached(pairs, start))
    found = lineage.graph_ancestors(edges, frame("id long", *[(s,) for s in start]))
    assert sorted(r["id"] for r in found.collect()) == sorted(_reached([(d, u) for u, d in pairs], start))


def test_a_chain_of_ten_thousand_takes_few_rounds(spark, monkeypatch):
    edges = spark.range(10_000).selectExpr("id AS upstream", "id + 1 AS downstream")
    written = []
    write, counting = lineage.Scratch.write, lineage.Scratch.write_counting
    monkeypatch.setattr(lineage.Scratch, "write", lambda self, df: written.append("table") or write(self, df))
    monkeypatch.setattr(lineage.Scratch, "write_counting", lambda self, df, mark: written.append("round") or counting(self, df, mark))
    before = _folders(spark)
    found = lineage.graph_descendants(edges, spark.range(1))
    assert found.count() == 10_001
    assert written.count("round") + lineage._LEVELS_APART < 20 and len(written) < 30
    read = {"/" + f.removeprefix("file:").lstrip("/").rsplit("/", 1)[0] for f in found.inputFiles()}
    left = {str(path) for path in _folders(spark) - before if path.is_dir()}
    assert read <= left and len(left) <= 12


def test_a_shallow_search_is_not_contracted(spark, frame, monkeypatch):
    monkeypatch.setattr(lineage, "_contracted", lambda *_: pytest.fail("contracted"))
    edges = frame("upstream string, downstream string", ("a", "b"), ("b", "c"), ("c", "a"))
    assert lineage.graph_descendants(edges, frame("id string", ("a",))).count() == 3


def test_many_selections_agree_with_one_search_each(frame):
    rng = random.Random(5)
    pairs = [(rng.randint(0, 40), rng.randint(0, 40)) for _ in range(60)] + [(1, 1), (2, 3), (3, 2)]
    starts = [(rng.randint(0, 63), rng.randint(0, 45)) for _ in range(90)] + [(63, 1), (0, None)]
    found = lineage.reach_many(frame("upstream long, downstream long", *pairs, (None, 1)), frame("selection int, id long", *starts))
    expected = {(s, node) for s in {s for s, _ in starts} for node in _reached(pairs, [i for k, i in starts if k == s and i is not None])}
    got = [(r["selection"], r["id"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_selections_beyond_the_bits_are_refused(frame):
    with pytest.raises(Exception, match="numbered from 0 to 63"):
        lineage.reach_many(frame("upstream long, downstream long", (1, 2)), frame("selection int, id long", (64, 1)))


def test_pointers_at_their_end_are_not_moved_again(spark, monkeypatch):
    """The rounds on one long chain together move a few pointers per node, however many rounds there are."""
    moved = []
    counting = lineage.Scratch.write_counting

    def counted(self, df, mark):
        table, marked = counting(self, df, mark)
        moved.append(table.count())
        return table, marked

    monkeypatch.setattr(lineage.Scratch, "write_counting", counted)
    edges = spark.range(20_000).selectExpr("id AS upstream", "id + 1 AS downstream")
    assert lineage.graph_descendants(edges, spark.range(1)).count() == 20_001
    assert len(moved) > 6 and sum(moved) < 5 * 20_000


def test_stored_edges_are_neither_stored_again_nor_made_distinct(spark, frame, monkeypatch):
    written = []
    write = lineage.Scratch.write
    monkeypatch.setattr(lineage.Scratch, "write", lambda self, df: written.append(df.columns) or write(self, df))
    edges, _, _ = lineage.Scratch(spark).write(frame("upstream long, downstream long", (1, 2), (1, 2), (2, 3)))
    written.clear()
    found = lineage.reach_many(edges, frame("selection int, id long", (0, 1), (5, 2)), edges_are_stored=True)
    assert sorted(map(tuple, found.collect())) == [(0, 1), (0, 2), (0, 3), (5, 2), (5, 3)]
    assert all(columns == ["id", "bits"] for columns in written)
