"""Suffix arrays by linear grouping, and the removal of repeated passages that rests on them."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from quarrymill.llm.suffix_dedup import _CUT, _OCCURRENCE, Passages, _removals, pieces, remove_repeated
from quarrymill.llm.suffix_groups import lyndon_groups, suffix_arrays

SMALL = Passages(slab_bytes=4000, most_slabs=3, lockstep_bytes=2000, part_bytes=20_000, bucket_bytes=200)


@pytest.mark.parametrize("letters", [1, 2, 3, 5, 200])
def test_suffix_arrays_equal_sorting(letters):
    rng = np.random.default_rng(letters)
    for width in (1, 2, 3, 7, 31, 64):
        length = rng.integers(1, width + 1, 40)
        text = rng.integers(1, letters + 1, (40, width)).astype(np.uint8)
        text[np.arange(40), length - 1] = 0
        order = suffix_arrays(text, length)
        for row in range(40):
            own = text[row, : length[row]].tobytes()
            assert order[row, : len(own)].tolist() == sorted(range(len(own)), key=lambda i: own[i:])
            assert (order[row, len(own) :] == -1).all()


def test_groups_are_those_of_the_longest_lyndon_prefix():
    def lyndon_prefix(s):
        return max((s[:k] for k in range(1, len(s) + 1) if all(s[:k] < s[j:k] for j in range(1, k))), key=len)

    rng = np.random.default_rng(3)
    for _ in range(50):
        own = bytes(rng.integers(1, 4, 25).astype(np.uint8)) + b"\0"
        group, pointer = lyndon_groups(np.frombuffer(own, np.uint8)[None, :].copy(), np.array([len(own)]))
        words = [lyndon_prefix(own[i:]) for i in range(len(own))]
        ranked = sorted(words)
        assert group[0].tolist() == [ranked.index(word) for word in words]
        smaller = [max((j for j in range(i) if words[j] < words[i]), default=-1) for i in range(len(own))]
        assert pointer[1:-1].tolist() == smaller[1:-1]


def test_equal_windows_meet_by_one_key():
    rng = random.Random(1)
    shared = bytes(rng.randrange(97, 123) for _ in range(400))
    texts = [bytes(rng.randrange(97, 123) for _ in range(rng.randrange(200))) + shared + b"x" * rng.randrange(90) for _ in range(6)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    v, text, start, windows = pieces(data, offsets, Passages())
    keys = {}
    for key, t, s, n in zip(v.tolist(), text.tolist(), start.tolist(), windows.tolist()):
        for at in range(s, s + n):
            assert offsets[t] <= at and at + 50 <= offsets[t + 1]
            keys.setdefault(data[at : at + 50].tobytes(), set()).add(key)
    assert all(len(found) == 1 for found in keys.values())
    assert sum(windows) == sum(len(t) - 49 for t in texts)


def _mixed(seed):
    rng = random.Random(seed)
    words = "alpha beta gamma delta epsilon ζήτα eta theta".split()
    shared = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 40))) for _ in range(20)]
    docs = []
    for _ in range(150):
        parts = [
            rng.choice(shared) if rng.random() < 0.4 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(1, 80)))
            for _ in range(rng.randint(0, 6))
        ]
        docs.append((rng.randint(0, 120), " ".join(parts)))
    both = shared[3] + shared[4] + shared[5]
    special = [(7, "a" * 3000), (9, "a" * 1000), (3, "ab" * 500), (11, "ab" * 700), (None, both * 2), (5, None), (6, "")]
    return docs + special + [(200, both), (201, both), (201, both), (202, both[:49]), (203, both[:50])]


@pytest.mark.parametrize("p", [Passages(), SMALL], ids=["production", "small"])
def test_removal_equals_brute_force(texts, rows, p):
    docs = _mixed(4)
    found = remove_repeated(texts(*docs).repartition(4), p, with_texts=False)
    assert rows(found) == sorted(brute.without_repeated(docs), key=repr)


def test_hot_copies_and_a_hot_passage(texts, rows):
    rng = random.Random(9)
    own = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    copy, passage = own(300), own(60)
    docs = [(i, copy) for i in range(100)] + [(100 + i, own(70) + passage + own(70)) for i in range(100)]
    docs += [(300 + i, own(120)) for i in range(50)] + [(400, copy)] * 30
    found = remove_repeated(texts(*docs).repartition(7), SMALL, with_texts=False)
    assert rows(found) == sorted(brute.without_repeated(docs), key=repr)


def test_a_hot_passage_is_shuffled_as_pieces(texts, monkeypatch):
    rng = random.Random(2)
    own = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = own(200)
    docs = texts(*[(i, own(70) + passage + own(70)) for i in range(60)]).repartition(60, "doc_id")
    counts, sort = [], type(docs).sortWithinPartitions
    monkeypatch.setattr(type(docs), "sortWithinPartitions", lambda self, *a, **k: counts.append(self.count()) or sort(self, *a, **k))
    for most in (3, 1000):
        remove_repeated(docs, Passages(slab_bytes=300, most_slabs=most))
    assert len(counts) == 2 and counts[0] <= counts[1]


@pytest.mark.parametrize("most", [0, 1])
def test_anchors_in_several_buckets_lose_the_same(texts, rows, most):
    rng = random.Random(6)
    own = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    passage = own(110)
    docs = _mixed(8) + [(rng.randint(300, 420), own(40) + passage[rng.randint(0, 40) :] + own(60)) for _ in range(150)]
    p = Passages(slab_bytes=700, most_slabs=most, lockstep_bytes=500, part_bytes=900, bucket_bytes=150)
    found = remove_repeated(texts(*docs).repartition(5), p, with_texts=False)
    assert rows(found) == sorted(brute.without_repeated(docs), key=repr)


@pytest.mark.parametrize("at_once", [1, 3, 40])
def test_removals_of_a_stream_do_not_depend_on_its_batches(at_once):
    rng = random.Random(5)
    shared = bytes(rng.randrange(97, 123) for _ in range(90))
    found = []
    for slab in range(50):
        own = shared if slab % 3 else bytes(rng.randrange(97, 123) for _ in range(30)) + shared[:70] + b"x" * 20
        data = np.frombuffer(own, np.uint8)
        for v, _, start, windows in zip(*pieces(data, np.array([0, len(own)]), Passages())):
            id_ = slab * 7 % 23
            place = np.array([(id_, 0, start)], _OCCURRENCE).tobytes()
            found.append((int(v.view(np.int64)), 0, own[start : start + windows + 49], id_, slab, place))
    found.sort(key=lambda row: (row[0], row[2], row[3]))
    names = ["v", "spread", "piece", "least", "slab", "places"]

    def cuts(size):
        cut = set()
        batches = [pa.RecordBatch.from_pylist([dict(zip(names, row)) for row in found[i : i + size]]) for i in range(0, len(found), size)]
        for batch in _removals(iter(batches), Passages(lockstep_bytes=50), False):
            for slab, blob in zip(*(batch.column(c).to_pylist() for c in ("slab", "cuts"))):
                cut |= {(slab, at) for _, a, b in np.frombuffer(blob, _CUT).tolist() for at in range(a, b)}
        return cut

    assert cuts(at_once) == cuts(len(found)) != set()


def test_spans_and_kept_bytes(texts, long_text):
    found = remove_repeated(texts((1, long_text), (2, "before " + long_text[:5000] + " after"), (3, "é" * 60))).collect()
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[1]["n_removed"] == 0 and bytes(by_id[1]["kept"]) == long_text.encode()
    assert [tuple(s) for s in by_id[2]["spans"]] == [(7, 5008)] or by_id[2]["n_removed"] >= 5000
    assert bytes(by_id[3]["kept"]).decode() == "é" * 60
    whole, spans = ("before " + long_text[:5000] + " after").encode(), by_id[2]["spans"]
    gone = b"".join(whole[s["start"] : s["end"]] for s in spans)
    assert len(gone) == by_id[2]["n_removed"] and len(gone) + len(by_id[2]["kept"]) == len(whole)


def test_an_empty_table(texts):
    found = remove_repeated(texts((1, "a")).limit(0))
    assert found.columns[:5] == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] and found.count() == 0
