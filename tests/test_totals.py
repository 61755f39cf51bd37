"""Totals per group that follow the facts."""

import random

import pytest

from quarrymill.operators import totals as totals_module
from quarrymill.operators.totals import Totals, merge_with_totals
from quarrymill.operators.upsert import DuplicateKeyError
from quarrymill.sinks import store as sinks

SCHEMA = "id long, who string, amount long, at int"
KEPT = Totals("t", "who", {"n": "1", "amount": "amount"}, {"last": "at"})


def _expected(facts):
    out = {}
    for _, who, amount, at in facts:
        if who is not None:
            n, total, last = out.get(who, (0, 0, None))
            out[who] = (n + 1, total + (amount or 0), at if last is None else last if at is None else max(last, at))
    return out


def _found(store):
    return {r["who"]: (r["n"], r["amount"], r["last"]) for r in store.table("t").collect()}


def test_random_loads_equal_the_full_build(store, frame):
    rng = random.Random(3)
    facts, keyless = {}, []
    for load in range(3):
        batch = {
            rng.randrange(60): (rng.choice(["a", "b", "c", "d", None]), rng.choice([None, rng.randrange(1000)]), rng.choice([None, rng.randrange(50)]))
            for _ in range(30)
        }
        none = [(None, "a", 5, 60 + load)]
        merge_with_totals(store, "facts", frame(SCHEMA, *[(k, *v) for k, v in batch.items()], *none), "id", KEPT)
        facts |= batch
        keyless += none
        if load == 0:
            sinks.lay_out_buckets(store, "facts", "id", 8)
            sinks.lay_out_buckets(store, "t", "who", 4)
        expected = _expected([(k, *v) for k, v in facts.items()] + keyless)
        found = {who: row for who, row in _found(store).items() if row[0]}
        assert found == expected
    assert store.table("facts").count() == len(facts) + len(keyless)


def test_new_facts_read_no_old_ones_and_gone_maxima_do(store, frame, monkeypatch):
    merge_with_totals(store, "facts", frame(SCHEMA, *[(i, "ab"[i % 2], 1, i) for i in range(100)]), "id", KEPT)
    sinks.lay_out_buckets(store, "facts", "id", 8)
    read = []
    original = totals_module.rows_of_keys

    def seen(store, table, keys, key):
        found = original(store, table, keys, key)
        read.append((table, found.count(), found._jdf.queryExecution().executedPlan().toString()))
        return found

    monkeypatch.setattr(totals_module, "rows_of_keys", seen)
    merge_with_totals(store, "facts", frame(SCHEMA, (200, "a", 2, 500)), "id", KEPT)
    ((count, plan),) = [(count, plan) for name, count, plan in read if name == "facts"]
    assert count == 0 and "ymill_bucket" in plan
    assert _found(store) == {"a": (51, 52, 500), "b": (50, 50, 99)}
    merge_with_totals(store, "facts", frame(SCHEMA, (200, "b", 2, 3)), "id", KEPT)
    assert _found(store) == {"a": (50, 50, 98), "b": (51, 52, 99)}


def test_a_load_that_failed_in_between_counts_once(store, frame, monkeypatch):
    merge_with_totals(store, "facts", frame(SCHEMA, (1, "a", 1, 1)), "id", KEPT)
    merge, calls = totals_module.write_merge, []

    def second_fails(*args, **options):
        calls.append(args[1])
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        return merge(*args, **options)

    monkeypatch.setattr(totals_module, "write_merge", second_fails)
    batch = frame(SCHEMA, (1, "a", 5, 2), (2, "a", 7, 9))
    with pytest.raises(RuntimeError):
        merge_with_totals(store, "facts", batch, "id", KEPT)
    monkeypatch.undo()
    merge_with_totals(store, "facts", batch, "id", KEPT)
    assert _found(store) == {"a": (2, 12, 9)} and store.table("facts").count() == 2


def test_what_cannot_be_kept_is_refused(store, frame):
    with pytest.raises(ValueError, match="taken back"):
        merge_with_totals(store, "f", frame("id long, who string, x double", (1, "a", 1.0)), "id", Totals("t", "who", {"x": "x"}))
    with pytest.raises(DuplicateKeyError):
        merge_with_totals(store, "f", frame(SCHEMA, (1, "a", 1, 1), (1, "a", 1, 1)), "id", KEPT)


def test_changes_are_worked_out_once(store, frame, monkeypatch):
    plans, merge = [], totals_module.write_merge

    def seen(store, table, df, *args, **options):
        if table == "t":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return merge(store, table, df, *args, **options)

    monkeypatch.setattr(totals_module, "write_merge", seen)
    merge_with_totals(store, "facts", frame(SCHEMA, (1, "a", 5, 9), (2, "a", 6, 3), (3, "b", 1, 1)), "id", KEPT)
    merge_with_totals(store, "facts", frame(SCHEMA, (1, "b", 7, 2)), "id", KEPT)
    # The latest value of `a` has gone, so the facts are asked: they are joined with the load, they and the load with the groups, and these with what was found.
    assert _found(store) == {"a": (1, 6, 3), "b": (2, 8, 2)}
    assert plans[1].count("Join ") <= 4
