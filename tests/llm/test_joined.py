"""Jaccard join, components, packing, archives, neighbours and the pipeline."""

import base64
import hashlib
import itertools
import random
import time
import zlib
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quarrymill.llm import jaccard, neighbours, packing, queries, warc
from quarrymill.llm.common import shared_path
from quarrymill.llm.components import components

SF = "/root/testdata/sf0.01"


def test_bands_never_miss_a_partner():
    likeness = jaccard.Likeness()
    for size in [*range(1, 400), 1000, 9999]:
        own = jaccard.bands_of(size, likeness)
        assert jaccard.bands(likeness)[own[-1]].low <= size <= jaccard.bands(likeness)[own[-1]].high
        for smaller in range(likeness.smallest(size), size + 1):
            band = jaccard.bands_of(smaller, likeness)[-1]
            assert band in own
            apart = next(d for d in range(smaller + size, -1, -1) if 100 * (smaller + size - d) // 2 * 1.0 >= 0 and
                         100 * (smaller + size - d) >= 85 * (smaller + size + d))
            assert apart <= jaccard.bands(likeness)[band].apart < jaccard.bands(likeness)[band].segments


def test_signatures_find_all_linked_pairs():
    """Pigeonhole on its own: linked sets share a signature, at least one of them whole."""
    rng = np.random.default_rng(5)
    likeness = jaccard.Likeness()
    for _ in range(1500):
        n = int(rng.integers(6, 150))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        apart = likeness.most_different(2 * n)
        drop = int(rng.integers(0, apart + 1))
        y = np.unique(np.concatenate([x[rng.permutation(len(x))[drop:]], rng.integers(0, 2**63, int(rng.integers(0, apart - drop + 1))).astype(np.uint64)]))
        common = len(np.intersect1d(x, y))
        if 100 * common < 85 * (len(x) + len(y) - common) or not len(y):
            continue
        if len(x) > len(y):
            x, y = y, x
        b = jaccard.bands_of(len(x), likeness)[-1]
        band = jaccard.bands(likeness)[b]
        if not band.apart:
            assert (x == y).all()
            continue
        (own_x, less_x, _), (own_y, less_y, _) = (jaccard.signatures(s, b, band) for s in (x, y))
        assert set(own_x) & set(own_y) or set(own_x) & set(less_y) or set(less_x) & set(own_y)


def near_copies(rng, n_groups, words=40):
    vocabulary = [f"v{k}" for k in range(300)]
    rows = []
    for g in range(n_groups):
        base = rng.choices(vocabulary, k=rng.choice([1, 3, 4, 7, 15, words, 120]))
        for _ in range(rng.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows) * 3 + 1, " ".join(copy)))
    return rows


def similar(docs, **options):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_sets(docs, jaccard.Likeness(**options)).collect()}


@pytest.mark.parametrize("crowded", [64, 1])
def test_components_agree_with_all_pairs(llm, texts, monkeypatch, crowded):
    monkeypatch.setattr(jaccard, "CROWDED", crowded)
    rng = random.Random(crowded)
    rows = near_copies(rng, 60)
    # A chain whose ends are not alike, a common passage, and tiny texts.
    chain = [f"c{k}" for k in range(80)]
    for k in range(12):
        rows.append((1000 + k, " ".join(chain[k * 2 : k * 2 + 50])))
    passage = [f"p{k}" for k in range(30)]
    for k in range(40):
        rows.append((2000 + k, " ".join([*passage, *[f"q{rng.randrange(1000)}" for _ in range(rng.choice([2, 5, 9, 20]))]])))
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "a"), (3004, "A"), (3005, "a b")]
    assert similar(texts(*rows)) == brute.components(rows, 4, 85, 100)
    assert similar(texts(*rows), shingle=5, least=80) == brute.components(rows, 5, 80, 100)


def test_copies_keep_one_row(llm, texts, long_text):
    rows = [(5, "x y z w v"), (3, "x y z w v"), (3, "x y z w v"), (None, "x y z w v"), (9, long_text), (8, long_text + " end"), (7, None), (6, "")]
    docs = texts(*rows)
    found = jaccard.similar_sets(docs).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.component_id) for r in found} == {(5, 3), (3, 3), (None, None), (9, 8), (8, 8), (7, 7), (6, 6)}
    kept = jaccard.remove_similar(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [3, 6, 7, 8, None]
    assert jaccard.similar_sets(docs.limit(0)).count() == 0 == jaccard.remove_similar(docs.limit(0)).count()


def thue_morse(n, a, b):
    return "".join(a if bin(k).count("1") % 2 == 0 else b for k in range(n))


def test_words_of_one_pattern_are_told_apart(texts):
    words = [thue_morse(n, *pair) for n in (1024, 2048, 64) for pair in ("ab", "ba", "xy", "yx")]
    words += ["a" * n for n in range(1, 40)] + ["abcdefgh" * n for n in (1, 2, 3)] + ["abcdefg", "bacdefgh", "abcdefgh\0"]
    rows = list(enumerate(words))
    assert similar(texts(*rows)) == {k: (1, k) for k, _ in rows}


def test_removal_judges_rows_by_their_text(texts):
    a, b, c = "a b c d e f", "one two three four five six", "g h i j k l"
    docs = texts((1, a), (5, a), (5, b), (6, c), (6, c), (7, b + " seven"), (7, c), (8, None), (8, None), (9, c), (9, ""))
    kept = jaccard.remove_similar(docs, jaccard.Likeness(shingle=5, least=80)).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == [(1, a), (5, b), (6, c), (7, b + " seven")]
    assert sum(r.text is None for r in kept) == 2 and sum(r.text == "" for r in kept) == 1
    # A hot text under one id and under many, beside unlike texts of the same ids.
    many = [(k % 40, a if k % 3 else f"own {k} words that no other row has") for k in range(240)]
    kept = jaccard.remove_similar(texts(*many).repartition(5)).collect()
    assert sorted(r.text for r in kept) == sorted([a, *[t for _, t in many if t != a]])


def test_copies_are_indexed_once_a_task(texts):
    rows = [(k, "the same text of some ten words in each of them") for k in range(300)]
    index = texts(*rows).repartition(3).select("text").mapInArrow(
        jaccard._indexed(jaccard.Likeness(shingle=2)), "signature long, class long, tag long"
    )
    assert index.groupBy("signature").count().agg(F.max("count")).first()[0] <= 3


def test_components_of_long_chains_and_stars(llm):
    links = [(k, k + 1) for k in range(1, 300)] + [(1000, k) for k in range(1001, 1100)] + [(2000, 1999), (2000, 1999), (5000, 5000)]
    got = {r.node: r.label for r in components(llm.createDataFrame(links, "a long, b long")).collect()}
    assert got[300] == 1 and got[1099] == 1000 and got[2000] == 1999 and got[5000] == 5000 and len(got) == 300 + 100 + 3
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


ODD = ["It's we'll I'D ''s 'S", "İstanbul ŉ ſ ΑΣ ς é é ́x Å Ⅳ ½ ٣٤ 12a3", "a<|endoftext|>b <|startoftext|>", "\t\r\n\x0b\x1c\x85  x", "日本語😀👍🏽", "×÷ßẞ", "", " ", "\x00\x7f", "...!!!'s", "naïve CAFÉ—x", "a b", "ÀÖØÞ"]


def test_ids_are_the_tokenizers():
    source = open(queries.tokenizer_file()).read()
    plain, fast = Tokenizer.from_str(source), packing.Encoder(source)
    assert fast.by_words
    rng = random.Random(2)
    letters = "aAzZ'sStTé É.,!-_\n\t 019ßñÑ日İΣ́<|>"
    given = [*ODD, " ".join(ODD[:2] + ODD[3:]), *["".join(rng.choices(letters, k=rng.choice([1, 5, 40]))) for _ in range(3000)]]
    for text in given:
        assert np.frombuffer(fast(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_part_is_looked_up_once_for_all_texts(monkeypatch):
    source = open(queries.tokenizer_file()).read()
    plain, fast = Tokenizer.from_str(source), packing.Encoder(source)
    given = ["the cat's the THE, the", "", "É 12the\tthe!'s", " \n", *ODD, "we'll the'd the"]
    looked = []
    monkeypatch.setattr(packing._Ids, "__getitem__", lambda self, part: looked.append(part) or self.__missing__(part), raising=False)
    found = fast.all(given)
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [plain.encode(x, add_special_tokens=False).ids for x in given]
    assert looked.count("the") == 1 and looked.count("'s") <= 3
    monkeypatch.setattr(packing, "_TOGETHER", 5)
    assert fast.all(given) == found and looked.count("the") > 2


def test_known_parts_cost_less_than_an_arrow_scalar_each():
    fast = packing.Encoder(open(queries.tokenizer_file()).read())
    letters = "abcdefghijklmnopqrst"
    parts = ["".join(x) for x in itertools.islice(itertools.product(letters, repeat=4), 20_000)]
    text, column = [" ".join(parts)], pa.array(parts, pa.large_string())
    fast.all(text)

    def least(work):
        took = []
        for _ in range(5):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)

    assert least(lambda: fast.all(text)) < 0.9 * least(column.to_pylist)


def test_numbers_are_written_in_any_length():
    for ids in ([], [0], [2**32 - 1] * 16, list(range(17)), [7, 2**31] * 500):
        assert np.frombuffer(packing._as_bytes(ids), "<u4").tolist() == ids


def test_parts_in_use_stay_known(monkeypatch):
    monkeypatch.setattr(packing, "_MOST_CACHED", 4)
    asked = []
    ids = packing._Ids(lambda part: asked.append(part) or [len(part), 2**32 - 1])
    for k in range(200):
        assert ids["the"] == b"\x03\0\0\0\xff\xff\xff\xff"
        assert len(ids[f"{k:03}" * 40]) == len(ids[f"{k}"]) == 8
        assert len(ids) + len(ids.before) <= 8 and all(len(part) <= 64 for part in ids)
    assert asked.count("the") == 1


def test_sequences_hold_every_token_once(llm, texts, long_text):
    rng = random.Random(7)
    rows = [(k, " ".join(rng.choices(["the", "of", "é", "x1"], k=rng.choice([0, 1, 30, 700, 1200])))) for k in range(150)]
    rows += [(900, None), (901, ""), (902, long_text), (902, "twice"), (None, "none")] + [(1000 + k, t) for k, t in enumerate(ODD)]
    packed = packing.pack(texts(*rows), queries.tokenizer_file(), pieces_per_group=40).collect()
    plain = Tokenizer.from_file(queries.tokenizer_file())
    expected = sorted([[*plain.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows])
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in packed:
        by_sequence[r.sequence_id].append(r)
        by_doc[r.doc_id, r.doc_tokens].append(r)
    found = []
    for (_, n), pieces in by_doc.items():
        ids, at = [], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.length * 4 == len(r.ids)
            at += r.length
            ids += np.frombuffer(r.ids, "<u4").tolist()
        assert at == n
        found.append(ids)
    assert sorted(found) == expected
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
        padding += 2048 - at
    assert padding < 2048 * 5
    assert packing.pack(texts(*rows).limit(0), queries.tokenizer_file()).count() == 0


def test_placement_is_balanced_and_tight():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(1, 2048, 500), np.full(9, 1500), np.array([5]), np.array([], int), np.full(4, 1024)):
        moves = packing.place(lengths, 2048)
        assert sum(m[2] for m in moves) == lengths.sum()
        assert len({m[3] for m in moves}) <= max(1, -(-int(lengths.sum()) // 2048))


INSIDE = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.1\r\n"


def pages(llm, rows):
    return llm.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, digest string")


@pytest.mark.parametrize("split", ["64m", "20k"])
def test_archives_read_back(llm, conf, split, long_text):
    rng = random.Random(3)
    rows = [(k, f"http://h/{k}", rng.choice(["same", "é日😀" * (k % 5), INSIDE, INSIDE * 3, "WARC/1.1\r\n", "p" * k, "", None])) for k in range(80)]
    rows += [(200, None, INSIDE + "y"), (201, "a\r\nContent-Length: 9", "z"), (None, "u", "no id"), (None, "u", "same"), (5, "u", "same"), (300, "u", long_text)]
    path = shared_path(llm, "test-archives")
    warc.write_archives(pages(llm, rows).repartition(3), path)
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1")
    got = sorted([tuple(r)[:5] for r in warc.read_archives(llm, path).collect()], key=repr)
    largest = {}
    for i, _, h in rows:
        if i is not None:
            largest[h or ""] = max(largest.get(h or "", i), i)
    expected = []
    for i, _, h in rows:
        body = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        keeper = largest.get(h or "")
        own = keeper is None or keeper == i
        expected.append((i, "response" if own else "revisit", len(body), digest, None if own else keeper))
    assert got == sorted(expected, key=repr)
    assert warc.read_archives(llm, path).filter("NOT intact").count() == 0


def test_archives_keep_all_long_ids(llm):
    ids = [-(2**63), -(10**18), 2**63 - 1, 10**18, -1, 0]
    path = shared_path(llm, "test-archives")
    warc.write_archives(pages(llm, [(k, "u", f"page {k % 5}") for k in ids]), path)
    got = {r.page_id: r.refers_to for r in warc.read_archives(llm, path).collect()}
    assert set(got) == set(ids)
    for k in ids:
        largest = max(i for i in ids if i % 5 == k % 5)
        assert got[k] == (None if largest == k else largest)
    assert [warc._number(x) for x in (None, "", "-", "--5", "5-", "\u0663", str(2**63), str(-(2**63) - 1))] == [None] * 8


def test_archives_of_no_pages_and_small_payloads(llm):
    path = shared_path(llm, "test-archives")
    warc.write_archives(pages(llm, [(1, "u", "a")]).limit(0), path)
    assert warc.read_archives(llm, path).count() == 0
    path = shared_path(llm, "test-archives")
    warc.write_archives(pages(llm, [(1, "u", "a"), (2, "u", "a")]), path, least_bytes=2)
    assert {r.record_type for r in warc.read_archives(llm, path).collect()} == {"response"}


def exact_neighbours(rows, queries_, k):
    good = [(i, np.array(v, float)) for i, v in rows]
    out = {}
    for q, x in good:
        if q % queries_ == 0:
            scored = [(-float((x * y).sum() / (np.sqrt((y * y).sum()) * np.sqrt((x * x).sum()))), i) for i, y in good if i != q]
            out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def test_recall_on_the_given_vectors(llm):
    """At least 0.9 at parameters that make many lists of the table."""
    vectors = llm.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    p = neighbours.Index(list_rows=40, block_rows=50)
    found = defaultdict(dict)
    for r in neighbours.nearest(vectors, lambda v: v % 50 == 0, p=p).collect():
        found[r.query_id][r.rank] = (r.vec_id, r.score)
    exact = exact_neighbours(rows, 50, 5)
    assert set(found) == set(exact)
    hits = 0
    for q, best in exact.items():
        assert list(sorted(found[q])) == [1, 2, 3, 4, 5]
        hits += len({i for i, _ in best} & {i for i, _ in found[q].values()})
        scores = dict(best)
        assert all(abs(scores[i] - s) < 1e-12 for i, s in found[q].values() if i in scores)
    assert hits >= 0.9 * 5 * len(exact)


def test_recall_does_not_fall_with_the_number_of_lists(llm):
    """1024 lists, as large tables have."""
    x = np.random.default_rng(8).normal(size=(20_480, 64)).astype(np.float32)
    vectors = llm.createDataFrame([*enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = defaultdict(set)
    for r in neighbours.nearest(vectors, lambda v: v % 256 == 0, p=neighbours.Index(list_rows=20)).collect():
        got[r.query_id].add(r.vec_id)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, len(x), 256):
        score = x @ x[q]
        score[q] = -1
        hits += len(got[q] & set(np.argsort(-score)[:5].tolist()))
    assert hits >= 0.9 * 5 * len(got) and len(got) == 80


def test_a_query_goes_on_until_it_has_found_enough(llm):
    """Lists of one id each, of which the distance ratio alone admits the query's own."""
    rows = [(i, [float(np.cos(i / 40)), float(np.sin(i / 40))]) for i in range(40)]
    vectors = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    p = neighbours.Index(list_rows=1, boundary=1.0, rounds=0)
    got = neighbours.nearest(vectors, lambda v: v % 10 == 0, p=p).collect()
    assert {(r.query_id, r.rank) for r in got} == {(q, k) for q in (0, 10, 20, 30) for k in (1, 2, 3, 4, 5)}


def test_neighbours_edge_cases(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0]), (10, [1.0, 1.0]), (10, [1.0, 1.0])]
    vectors = llm.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, v string")
    got = [(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(vectors, lambda v: v % 10 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 10), (0, 3, 2), (10, 1, 0), (10, 2, 1), (10, 3, 2)]
    assert neighbours.nearest(vectors.limit(0), lambda v: v % 10 == 0).collect() == []
    same = llm.createDataFrame([(k, [0.1, 0.7]) for k in range(900)], "vec_id long, embedding array<float>")
    p = neighbours.Index(list_rows=50, block_rows=100)
    tied = neighbours.nearest(same, lambda v: v == 450, p=p).orderBy("rank").collect()
    assert [r.vec_id for r in tied] == [0, 1, 2, 3, 4]


def test_pipeline_stages(llm):
    documents = llm.read.parquet(f"{SF}/documents.parquet")
    docs, kept = documents, []
    for _, stage in corpus_pipeline.STAGES:
        path = shared_path(llm, "test-pipeline")
        stage(llm, docs, SF).write.parquet(path)
        docs = llm.read.parquet(path)
        kept.append(docs)
    toxic, distinct, decontaminated, redacted, packed = kept
    for stage in kept[:4]:
        assert stage.dtypes == documents.dtypes
    rows = [(r.doc_id, r.text) for r in toxic.collect()]
    expected = brute.components(rows, 5, 80, 100)
    assert {r.doc_id for r in distinct.collect()} == {c for _, c in expected.values()}
    bench = [(r.item_id, r.text) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in distinct.collect()]
    clean = {d for d, _, n, _ in brute.contamination(rows, bench) if n == 0}
    assert {r.doc_id for r in decontaminated.collect()} == clean and 0 < len(clean) < len(rows)
    final = redacted.collect()
    assert {r.doc_id for r in final} == clean
    assert all(r.n_chars == len(r.text) and not brute.base_spans(r.text) for r in final)
    total = packed.agg(F.sum("length")).first()[0]
    plain = Tokenizer.from_file(queries.tokenizer_file())
    assert total == sum(len(plain.encode(r.text, add_special_tokens=False).ids) + 1 for r in final)


def test_packed_digest(llm, texts):
    row = queries.packed_digest(packing.pack(texts((4, "the of")), queries.tokenizer_file())).first()
    ids = [*Tokenizer.from_file(queries.tokenizer_file()).encode("the of", add_special_tokens=False).ids, 1]
    assert row.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and row.doc_tokens == 3
