"""Bounds of scores from angles, and the mining that rests on them, against all pairs."""

import numpy as np
import pytest

from quarrymill.llm.hard_negatives import (
    Mining,
    angles_to,
    inner_products,
    mine,
    reference_directions,
    score_bounds,
)

SMALL = Mining(block_rows=7, visitors=5, references=3, growth=2, most_sampled=40)


def _brute(rows, modulus=5, scale=256):
    good = {(i, label, tuple(int(np.floor(scale * c)) for c in v)) for i, label, v in rows
            if i is not None and label is not None and v is not None
            and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for anchor, label, a in (g for g in good if g[0] % modulus == 0):
        scored = [(-sum(s * t for s, t in zip(a, x)), i, other) for i, other, x in good if i != anchor and len(x) == len(a)]
        for minus, positive, _ in sorted(r for r in scored if r[2] == label)[:5]:
            fit = sorted(r for r in scored if r[2] != label and 50 * -minus <= 100 * -r[0] <= 95 * -minus)[:3]
            out += [(anchor, positive, rank, r[1], -minus, -r[0]) for rank, r in enumerate(fit, 1)]
    return sorted(out)


def _table(llm, rows):
    return llm.createDataFrame([(i, v, label, 1, "x") for i, label, v in rows], "vec_id long, embedding array<double>, label int, score int, anchor string")


def _found(llm, rows, p=SMALL):
    return sorted(tuple(r) for r in mine(_table(llm, rows).repartition(3), lambda v: v % 5 == 0, p).collect())


def test_bounds_hold_for_all_pairs():
    rng = np.random.default_rng(0)
    for spread in (0.01, 1.0, 50.0):
        x = np.floor((rng.normal(size=(120, 6)) * spread + rng.normal(size=6)) * 256)
        x[5], x[6] = 0.0, x[7]
        norms, references = np.linalg.norm(x, axis=1), reference_directions(x, 4)
        angles = angles_to(x, norms, references)
        for k in range(len(x)):
            low, high = score_bounds(angles[k], norms[k], angles, angles, norms, norms)
            score = inner_products(x, x[k])
            assert ((low <= score) & (score <= high)).all()
            low, high = score_bounds(
                angles[k], norms[k], angles.min(axis=0)[None], angles.max(axis=0)[None], norms.min(keepdims=True), norms.max(keepdims=True)
            )
            assert low[0] <= score.min() and score.max() <= high[0]


def test_scores_are_exact_beyond_doubles():
    a = np.array([2.0**30 + 1, 3.0])
    assert inner_products(np.array([[2.0**30 + 3, 5.0]]), a).tolist() == [(2**30 + 1) * (2**30 + 3) + 15]
    with pytest.raises(OverflowError):
        inner_products(np.array([[2.0**40]]), np.array([2.0**40]))


@pytest.mark.parametrize("p", [Mining(), SMALL], ids=["production", "small"])
def test_mining_equals_all_pairs(llm, p):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(4, 8))
    rows = [(i, int(rng.integers(0, 3)), (centres[i % 4] + rng.normal(size=8) * 0.5).tolist()) for i in range(120)]
    expected = _brute(rows)
    assert len(expected) > 50 and _found(llm, rows, p) == expected


def test_hot_vector_ties_repeats_and_bad_rows(llm):
    rng = np.random.default_rng(2)
    rows = [(i, i % 2, [1.0, 0.5, 0.25]) for i in range(60)]
    rows += [(60 + i, int(rng.integers(0, 2)), rng.normal(size=3).round(1).tolist()) for i in range(80)]
    rows += rows[:10] + [(5, 1, [0.9, 0.5, 0.2]), (7, 0, [0.8, 0.4, 0.2])]
    nan, inf = float("nan"), float("inf")
    rows += [(200, None, [1.0, 1.0, 1.0]), (205, 1, None), (210, 1, [1.0, None, 1.0]), (215, 0, [nan, 1.0, 1.0]), (220, 0, [inf, 1.0, 1.0])]
    rows += [(None, 1, [1.0, 1.0, 1.0]), (225, 1, [0.0, 0.0, 0.0]), (226, 0, [0.0] * 3), (227, 1, [0.0] * 3), (230, 1, [1.0, 2.0]), (231, 1, [1.0, 2.5]), (232, 0, [0.5, 1.0])]
    assert _found(llm, rows) == _brute(rows)


def test_empty_tables_and_lone_rows(llm):
    assert _found(llm, []) == []
    assert _found(llm, [(5, 1, [1.0, 2.0])]) == []
    assert _found(llm, [(5, 1, [1.0, 2.0]), (6, 1, [1.0, 2.0]), (10, 2, [])]) == []
