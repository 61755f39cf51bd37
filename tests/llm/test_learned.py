"""Toxicity, personal data and language-model scoring."""

import functools
import math
import random
import tracemalloc
from pathlib import Path

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrymill.llm import language_model, pii, queries, toxicity
from quarrymill.llm.bytewords import ALPHANUMERIC, NOT_BLANK, slices
from quarrymill.llm.common import in_fold

SF = "/root/testdata/sf0.1"


@pytest.mark.parametrize("of_word, pattern", [(ALPHANUMERIC, brute.ALPHANUMERIC), (NOT_BLANK, brute.NOT_BLANK)])
def test_words_on_bytes_are_the_words(of_word, pattern, monkeypatch):
    monkeypatch.setattr("quarrymill.llm.bytewords.SLICE_BYTES", 50)
    rng = random.Random(1)
    given = ["".join(rng.choices("aAbB zÉé.\t\n\x00 9_日😀-", k=rng.choice([0, 1, 3, 30, 120]))) for _ in range(300)]
    given[5] = None
    seen, rows = {}, 0
    for first, last, found in slices(pa.array(given).slice(3), of_word):
        for k in range(first, last):
            own = found.hashes[found.bounds[k - first] : found.bounds[k - first + 1]].tolist()
            expected = brute.words(given[k + 3], pattern)
            assert len(own) == len(expected)
            for h, w in zip(own, expected):
                assert seen.setdefault(w, h) == h
            rows += 1
    assert rows == 297 and len(set(seen.values())) == len(seen)


def test_grams_stay_within_a_text():
    (_, _, found), = slices(pa.array(["a b c", "a b", None, "c a b"]), NOT_BLANK)
    grams, owner = found.grams(2)
    assert owner.tolist() == [0, 0, 1, 3, 3] and grams[0] == grams[2] == grams[4] != grams[3]
    skipped, owner = found.grams(2, skip=1)
    assert owner.tolist() == [0, 3] and skipped[0] != skipped[1]


def test_toxicity_on_held_out_labels(llm):
    docs, labels = llm.read.parquet(f"{SF}/documents.parquet"), llm.read.parquet(f"{SF}/labels.parquet")
    scored = queries.op3_toxicity(llm, SF)
    assert scored.count() == docs.count()
    held = scored.filter("held_out").join(labels, "doc_id").toPandas()
    hit = ((held.predicted == 1) & (held.toxic == 1)).sum()
    # A few hundred toxic texts in four languages are little to learn from; ten times as many give 0.99.
    assert hit / held.toxic.sum() > 0.7 and hit / held.predicted.sum() > 0.9


def test_stored_buckets_take_little_space(llm):
    rng = np.random.default_rng(1)
    rows = [(k % 2, np.unique(rng.integers(0, 1 << 18, 1000)).tolist(), k, k, k % 3) for k in range(300)]
    table = llm.createDataFrame(rows, "label int, buckets array<int>, doc long, order long, slab int")
    stored = toxicity._in_slabs(table.repartition("slab"), ["doc", "order"])
    assert sorted((r.doc, r.buckets) for r in stored.collect()) == sorted((r[2], r[1]) for r in rows)
    files = [Path(name.removeprefix("file:").replace("///", "/")) for name in stored.inputFiles()]
    assert sum(file.stat().st_size for file in files) < 2 * 300 * 1000


def test_slabs_of_a_task_are_added_up_before_the_shuffle(llm, texts, conf, monkeypatch):
    conf(spark__sql__files__maxPartitionBytes="64k")
    docs = texts(*[(k, "you utter moron" if k % 2 else "fine words here") for k in range(400)])
    labels = llm.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    seen = []
    own = type(docs).groupBy
    monkeypatch.setattr(type(docs), "groupBy", lambda self, *keys: (seen.append(self) if str(keys) == "('at',)" else None) or own(self, *keys))
    toxicity.fit(docs, labels, F.lit(True), toxicity.Ftrl(slab_rows=10, epochs=1))
    (changes,) = seen
    assert changes.rdd.getNumPartitions() <= llm.sparkContext.defaultParallelism


def test_toxicity_edge_cases(llm, texts, long_text):
    rows = [(k, "you utter moron" if k % 2 else "fine words here") for k in range(60)]
    rows += [(100, None), (101, ""), (102, long_text), (103, long_text + " moron"), (None, "moron"), (1, "you utter moron")]
    docs = texts(*rows)
    labels = llm.createDataFrame(
        [(k, k % 2) for k in range(60)] + [(1, 1), (2, None), (None, 1)], "doc_id long, toxic int"
    )
    p = toxicity.Ftrl(l1=0.1, epochs=8)
    weights = toxicity.fit(docs, labels, F.lit(True), p)
    assert 0 < len(weights.buckets) < 40
    scored = toxicity.score(docs, weights)
    assert scored.columns == [*docs.columns, "score"]
    got = {(r.doc_id, r.text): r.score for r in scored.collect()}
    assert got[1, "you utter moron"] > 0.7 > got[2, "fine words here"]
    assert got[100, None] == got[101, ""] and 0 <= got[100, None] <= 1
    assert got[103, long_text + " moron"] > got[102, long_text]
    kept = toxicity.remove_toxic(docs, labels, F.lit(True), p=p)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for (d, _), score in got.items() if score < 0.7 and d is not None}
    assert {*range(0, 60, 2), 100, 101, 102} <= {r.doc_id for r in kept.collect()}


def test_toxicity_learns_from_bounded_rows(llm, texts, monkeypatch):
    rows = [(k, "you utter moron" if k % 2 else "fine words here") for k in range(10)]
    docs = texts(*rows, *[(1, "you utter moron")] * 200, *[(2, f"fine words {k}") for k in range(50)])
    labels = llm.createDataFrame([(k, k % 2) for k in range(10)], "doc_id long, toxic int")
    p = toxicity.Ftrl(most_rows=5)
    assert toxicity.training_rows(docs, labels, F.lit(True), p, "doc_id", "text").count() == 60
    features = llm.createDataFrame([(k % 40, k % 2, [k]) for k in range(90)], "doc long, label int, buckets array<int>")
    kept = toxicity._bounded(features, {0: 45, 1: 45}, 5).groupBy("label").count().collect()
    assert sorted(map(tuple, kept)) == [(0, 5), (1, 5)]
    assert toxicity._bounded(features, {0: 45, 1: 45}, 45).count() == 90
    assert len(toxicity.fit(docs, labels, F.lit(True), toxicity.Ftrl(most_rows=5, l1=0.1)).buckets) > 0


def test_the_learner_is_plain_ftrl():
    """Coordinate by coordinate, against the update rule written out over dicts."""
    rng = random.Random(4)
    p = toxicity.Ftrl(l1=0.3, bits=8)
    rows = [(sorted(rng.sample(range(40), rng.randint(0, 8))), rng.randint(0, 1)) for _ in range(120)]
    z, n = np.zeros((1 << 8) + 1), np.zeros((1 << 8) + 1)
    plain_z, plain_n = {}, {}

    def weight(i):
        zi, l1 = plain_z.get(i, 0.0), 0.0 if i == "bias" else p.l1
        if abs(zi) <= l1:
            return 0.0
        return -(zi - math.copysign(l1, zi)) / ((p.beta + math.sqrt(plain_n.get(i, 0.0))) / p.alpha + p.l2)

    for _ in range(3):
        toxicity._pass([(np.array(x, int), y) for x, y in rows], z, n, p)
        for x, y in rows:
            w = {i: weight(i) for i in [*x, "bias"]}
            g = 1 / (1 + math.exp(-sum(w.values()))) - y
            for i, wi in w.items():
                before = plain_n.get(i, 0.0)
                sigma = (math.sqrt(before + g * g) - math.sqrt(before)) / p.alpha
                plain_z[i] = plain_z.get(i, 0.0) + g - sigma * wi
                plain_n[i] = before + g * g
    for i in range(40):
        assert math.isclose(z[i], plain_z.get(i, 0.0), rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(n[i], plain_n.get(i, 0.0), rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(toxicity._weights_of(z[i : i + 1], n[i : i + 1], p)[0], weight(i), rel_tol=1e-9, abs_tol=1e-12)
    assert math.isclose(z[-1], plain_z["bias"], rel_tol=1e-9)
    assert sum(weight(i) == 0.0 for i in range(40)) > 0


def test_scores_are_sums_over_distinct_features(llm, texts, long_text):
    """Words, their first four and five bytes, pairs of neighbours and pairs with one word between: each once a text."""
    given = ["You utter MORON you", "", None, "éa éa b", "a b a b a b", "one", long_text[:3000]]
    bits = 20
    found = list(toxicity._row_features(pa.array(given), bits))
    for text, buckets in zip(given, found):
        w = [x.encode() for x in brute.words(text)]
        features = {("w", x) for x in w} | {(k, x[:k]) for k in toxicity.STEM_BYTES for x in w}
        features |= {("2", *x) for x in zip(w, w[1:])} | {("skip", *x) for x in zip(w, w[2:])}
        assert 0.99 * len(features) <= len(buckets) <= len(features)
    every = np.unique(np.concatenate(found))
    values = np.random.default_rng(0).normal(size=len(every)) / 50
    weights = toxicity.Weights(every, values, -0.25, bits)
    scored = {r.doc_id: r.score for r in toxicity.score(texts(*enumerate(given)), weights).collect()}
    for k, buckets in enumerate(found):
        total = sum(values[np.searchsorted(every, b)] for b in buckets.tolist()) - 0.25
        assert math.isclose(scored[k], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_toxicity_without_labels_or_documents(llm, texts):
    labels = llm.createDataFrame([(1, 1)], "doc_id long, toxic int")
    docs = texts((1, "a"), (2, "b"))
    for given, known in [(docs, labels), (docs, labels.limit(0)), (docs.limit(0), labels)]:
        scored = toxicity.score(given, toxicity.fit(given, known, F.lit(True))).collect()
        assert {r.score for r in scored} <= {0.5} and len(scored) == given.count()


def test_base_spans_agree_with_plain_patterns():
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "x@y.zz", "1", "22", "255", "256", ".", "-", " ", "+", "+1", "(", ")", "4111 1111 1111 1111",
             "4512463504900732", "10.0.0.1", "é", "٣", "\n", "007", "0000300.1.1.1", "+49 (30) 555-1234"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.choice([1, 3, 8, 25])))
        assert pii.base_spans(text) == brute.base_spans(text), text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "a@", "@", "+1", "+1 ", "1 ", "a.", "(at)", "1-"])
def test_long_runs_take_linear_time(unit):
    text = unit * (200_000 // len(unit))
    model = pii.Model([pii.Tree(np.zeros(0, int), np.zeros(0), np.zeros(1))], {k: 0.1 for k in pii.KINDS})
    pii.spans_of(text, model)


def test_boosting_learns_and_calibrates():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 6, (3000, 4)).astype(float)
    y = ((x[:, 0] > 2) & (x[:, 1] < 3)).astype(float)
    model = pii.boost(x, y, pii.Boosting())
    assert ((model.score(x) > 0.5) == (y > 0)).mean() > 0.99
    score = np.array([0.9, 0.8, 0.7, 0.6, 0.5, 0.4])
    assert pii._threshold(score, np.array([1, 1, 1, 1, 1, 0.0]), 0.99) == 0.5
    assert pii._threshold(score, np.zeros(6), 0.99) > 1 and pii._threshold(score[:0], score[:0], 0.99) > 1


def test_personal_data_edge_cases(llm, texts, long_text):
    docs = texts((1, None), (2, ""), (3, long_text + " x@y.zz"), (4, "☎ +49 (30) 555-1234 x@y.zz"), (4, "10.0.0.1"), (None, "x@y.zz"))
    model = pii.fit(docs)
    found = pii.find(docs, model)
    assert found.columns == [*docs.columns, "pii"]
    got = {(r.doc_id, r.text): [(s.kind, s.start, s.end) for s in r.pii if s.base] for r in found.collect()}
    assert got[1, None] == got[2, ""] == []
    assert got[4, "☎ +49 (30) 555-1234 x@y.zz"] == [("email", 20, 26), ("phone", 2, 19)]
    assert len(got[3, long_text + " x@y.zz"]) == 1 and len(got) == 6
    clean = pii.redact(docs, model)
    assert clean.columns == docs.columns
    texts_now = {(r.doc_id, r.text) for r in clean.collect()}
    assert (4, "☎ [PHONE] [EMAIL]") in texts_now and (4, "[IP]") in texts_now and (1, None) in texts_now
    assert pii.find(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def test_added_spans_touch_no_base_span(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model = pii.fit(docs)
    for r in pii.find(docs, model).filter("size(pii) > 0").collect():
        spans = [(s.kind, s.start, s.end) for s in r.pii if s.base]
        assert spans == brute.base_spans(r.text)
        for s in r.pii:
            assert s.base or all(s.end <= b or s.start >= e for _, b, e in spans)


def lm(docs, training, **options):
    found = language_model.score(docs, training, language_model.Parameters(**options))
    return found.collect()


def test_unigrams_agree_with_brute_force(llm, texts, long_text):
    rng = random.Random(6)
    rows = [(k, " ".join(rng.choices("aA bB cc é É , the of and".split(), k=rng.choice([0, 1, 5, 60])))) for k in range(50)]
    rows += [(60, None), (61, ""), (62, long_text), (63, "\x00 a\x0bb \x1c")]
    expected = brute.unigram_scores(rows, lambda d: brute.crc(d) % 7 != 2)
    for options in ({}, {"slab_bytes": 300, "part_keys": 40, "segment": 3}):
        got = lm(texts(*rows), ~in_fold("doc_id", 7, 2), **options)
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:3]
            assert math.isclose(r.base_score, expected[r.doc_id][3], rel_tol=1e-9)
            assert r.score < 0


def test_repeated_and_missing_rows(llm, texts):
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, None)]
    got = lm(texts(*rows), F.lit(True))
    assert sorted(r.n_tokens for r in got) == [1, 3, 3, 3]
    assert lm(texts(*rows).limit(0), F.lit(True)) == []
    untrained = lm(texts(*rows), F.lit(False))
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in untrained)


def counted(texts):
    """Counts of the n-grams of up to three tokens, and the probabilities that follow from them."""
    count = {}
    for text in texts:
        w = [*brute.words(text, brute.NOT_BLANK), brute.END]
        for n in (1, 2, 3):
            for i in range(len(w) - n + 1):
                count[tuple(w[i : i + n])] = count.get(tuple(w[i : i + n]), 0) + 1
    single = [c for g, c in count.items() if len(g) == 1]
    total, distinct, prior = sum(single), len(single), language_model.Parameters().prior

    @functools.cache
    def probability(history, w):
        if not history:
            return (count.get((w,), 0) + 1) / (total + distinct + 1)
        lower, of_history = probability(history[1:], w), count.get(history, 0)
        return (count.get((*history, w), 0) + prior * lower) / (of_history + prior) if of_history else lower

    return count, probability


def test_the_automaton_is_a_backoff_model():
    """Every history's probabilities sum to 1, and each step's weight is that of the longest known history."""
    rng = random.Random(9)
    taught = [" ".join(rng.choice("abcd") if rng.random() < 0.7 else "a" for _ in range(40)) for _ in range(9)]
    others = ["a b c d zz a a b", "zz yy", "", "d c b a " * 9]
    count, probability = counted(taught)
    vocabulary = [*"abcd", brute.END]
    for history in [("a",), ("b", "a"), ("c", "d")]:
        assert math.isclose(sum(probability(history, w) for w in vocabulary) + probability(history, "never"), 1, rel_tol=1e-3)
    grams = language_model.Grams(pa.array([*taught, *others]))
    of_token = np.repeat(np.arange(len(grams.bounds) - 1) < len(taught), np.diff(grams.bounds))
    counts = [np.bincount(at[(at >= 0) & of_token], minlength=len(k)) for k, at in zip(grams.keys, grams.at)]
    single = [c for g, c in count.items() if len(g) == 1]
    model = language_model.Automaton(grams, counts, sum(single), len(single), language_model.Parameters())
    assert (model.fail[1:] < np.arange(1, len(model.fail))).all() and (model.backoff[1:] < 0).all()
    state = np.zeros(1, np.int64)
    for k, text in enumerate([*taught, *others]):
        w, state = [*brute.words(text, brute.NOT_BLANK), brute.END], np.zeros(1, np.int64)
        for i, x in enumerate(w):
            state, weight = model.step(state, grams.at[0][grams.bounds[k] + i : grams.bounds[k] + i + 1])
            assert math.isclose(weight[0], math.log10(probability(tuple(w[max(0, i - 2) : i]), x)), rel_tol=1e-9)
    whole = model.walk(grams.at[0], grams.bounds, 10_000)
    assert np.allclose(model.walk(grams.at[0], grams.bounds, 4), whole, rtol=1e-12)


def test_packed_numbers_come_back():
    rng = np.random.default_rng(0)
    for keys in (np.zeros(0, np.uint64), np.array([0, 1, 2**64 - 1], np.uint64), np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))):
        assert (language_model.unpack_sorted(language_model.pack_sorted(keys)) == keys).all()
    for counts in (np.zeros(0, np.int64), np.array([0, 255]), np.array([7, 256]), np.array([2**40, 0])):
        assert (language_model.unpack_counts(language_model.pack_counts(counts)) == counts).all()


def test_places_of_keys_in_order():
    """Also of keys of which only the lower bits differ, which do not fit beside the places."""
    rng = np.random.default_rng(3)
    wide = rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2)
    for keys in (wide, rng.permutation(np.concatenate((wide, wide[:900], wide[:500] + np.uint64(1)))), wide >> np.uint64(50), wide[:1], wide[:0]):
        assert (keys[language_model.ordered(keys)] == np.sort(keys)).all()
        distinct, at, place = language_model.ranked(keys)
        assert (distinct == np.unique(keys)).all() and (distinct[at] == keys).all() and (keys[place] == distinct).all()


def test_walking_holds_one_slab_at_a_time():
    rng = np.random.default_rng(1)
    slabs = [[" ".join(f"w{int(k)}" for k in 20_000 * rng.random(400) ** 3) for _ in range(200)] for _ in range(3)]
    found, longer = [], []
    for texts in slabs:
        grams = language_model.Grams(pa.array(texts))
        short = language_model.Grams(pa.array(texts), 64, (1, 2))
        assert short.keys[2] is None and all((a == b).all() for a, b in zip(short.at[:2], grams.at))
        counts = [2 * np.bincount(at[at >= 0]) for at in grams.at]
        asked = language_model._asked(grams, np.ones(len(grams.tokens), bool), counts[1])
        assert asked.all()
        parts = [{"size": n + 1, "part": 0, "counts": language_model.pack_counts(c)} for n, c in enumerate(counts)]
        found.append(parts[:2])
        longer.append(parts[2:])
    total, distinct = int(counts[0].sum()), len(counts[0])
    back = pa.list_(pa.struct([("size", pa.int32()), ("part", pa.int32()), ("counts", pa.binary())]))
    columns = {"docs": [list(range(200))] * 3, "taughts": [[True] * 200] * 3, "texts": slabs}
    batch = pa.record_batch({**columns, "found": pa.array(found, back), "longer": pa.array(longer, back)})
    size = sum(map(len, slabs[0]))
    tracemalloc.start()
    try:
        rows = sum(len(b) for b in language_model._walked([batch], total, distinct, 64, language_model.Parameters()))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 600 and peak < 55 * size, peak / size


def test_model_beats_single_words_on_held_out_texts(llm):
    got = queries.op7_language_model(llm, SF).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_rare_ngrams_of_a_large_corpus_are_in_the_model(llm, texts):
    rng = random.Random(12)
    rows = [(k, " ".join(rng.choices("abcdefghij", k=6_000))) for k in range(60)]
    rows += [(100, "x y z"), (101, "x y a"), (102, "y z"), (103, "n y z o"), (104, None), (105, "x y z")]
    taught = {k for k, _ in rows if k not in (3, 101, 102, 103)}
    count, probability = counted([t for k, t in rows if k in taught])
    assert sum(c for g, c in count.items() if len(g) == 1) > 300_000
    p = language_model.Parameters(slab_bytes=200_000)
    got = language_model.score(texts(*rows).repartition(3), F.col("doc_id").isin(*taught), p).collect()
    assert len(got) == len(rows)
    for r in got:
        w = [*brute.words(dict(rows)[r.doc_id], brute.NOT_BLANK), brute.END]
        expected = sum(math.log10(probability(tuple(w[max(0, i - 2) : i]), x)) for i, x in enumerate(w))
        assert math.isclose(r.score, expected, rel_tol=1e-9), r


def _beyond(docs, seed, most):
    """Ids that a choice of the `most` smallest hashes passes over."""
    order = [F.xxhash64("doc_id", F.lit(seed)), "doc_id"]
    return {r.doc_id for r in docs.select("doc_id").orderBy(*order).offset(most).collect()}


def test_toxicity_learns_from_every_labelled_row(llm):
    """More labelled rows than one slab holds; a word that only some late ones have."""
    ids = llm.range(9_000).toDF("doc_id")
    labels = ids.selectExpr("doc_id", "cast(doc_id % 2 as int) AS toxic")
    late = _beyond(labels.filter("toxic = 1"), 7, 4000)
    assert len(late) == 500
    said = F.when(F.col("doc_id").isin(*late), "vile thing").when(F.col("doc_id") % 2 == 1, "utter moron").otherwise("kind words")
    docs = ids.withColumn("text", said)
    weights = toxicity.fit(docs, labels, F.lit(True))
    scored = toxicity.score(docs, weights).groupBy("text").agg(F.min("score"), F.max("score"))
    got = {text: (low, high) for text, low, high in scored.collect()}
    assert got["vile thing"][0] > 0.7 and got["utter moron"][0] > 0.7 > 0.3 > got["kind words"][1]
    again = toxicity.fit(docs, labels, F.lit(True))
    assert np.array_equal(weights.buckets, again.buckets) and np.array_equal(weights.values, again.values)


def test_one_slab_is_plain_ftrl_and_more_are_its_mean(llm, texts):
    docs = texts(*[(k, "utter moron" if k % 3 else "fine words") for k in range(90)])
    labels = llm.createDataFrame([(k, int(k % 3 > 0)) for k in range(90)], "doc_id long, toxic int")
    p = toxicity.Ftrl(l1=0.1, bits=10, epochs=3)
    rows = docs.join(labels, "doc_id").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").collect()
    found = toxicity._row_features(pa.array([r.text for r in rows]), p.bits)
    given = list(zip(found, [r.toxic for r in rows]))
    z, n = np.zeros((1 << p.bits) + 1), np.zeros((1 << p.bits) + 1)
    for _ in range(p.epochs):
        toxicity._pass(given, z, n, p)
    weights = toxicity.fit(docs, labels, F.lit(True), p)
    assert np.allclose(weights.dense(), toxicity._weights_of(z[:-1], n[:-1], p), atol=1e-6)
    assert math.isclose(weights.bias, toxicity._bias_of(z[-1], n[-1], p), abs_tol=1e-6)
    several = toxicity.fit(docs, labels, F.lit(True), toxicity.Ftrl(l1=0.1, bits=10, epochs=3, slab_rows=30))
    assert np.array_equal(np.sign(several.dense()), np.sign(weights.dense()))


def test_personal_data_is_learned_from_every_text(llm):
    """Only texts that a choice of 12,000 would pass over hold any."""
    ids = llm.range(12_300).toDF("doc_id")
    late = _beyond(ids, 5, 12_000)
    docs = ids.withColumn("text", F.when(F.col("doc_id").isin(*late), F.format_string("mail a%s@y.zz", "doc_id")).otherwise("none"))
    model = pii.fit(docs, pii.Boosting(trees=2))
    assert len(model.trees) == 2 and model.thresholds["email"] <= 1


def test_trees_on_a_table_are_those_on_its_rows(llm):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 4, (800, 5)).astype(float)
    y = ((x[:, 0] > 1) ^ (x[:, 1] > 2)).astype(float)
    p = pii.Boosting(trees=3)
    rows = llm.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y)], "x array<double>, y double")
    table = rows.repartition(5).groupBy("x", "y").agg(F.count(F.lit(1)).alias("count"))
    one, two = pii.boost(x, y, p), pii._boosted(lambda *at: pii._sums_of_table(table, *at), p)
    for a, b in zip(one.trees, two.trees):
        assert np.array_equal(a.feature, b.feature) and np.array_equal(a.cut, b.cut) and np.array_equal(a.leaf, b.leaf)
