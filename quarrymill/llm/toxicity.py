"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrymill.llm.bytewords import ALPHANUMERIC, Words, mix, slices
from quarrymill.llm.common import bounded, mapped, shared_path, staged

BUCKET_BITS = 18
# First bytes of a word that are features as well, for languages that inflect.
STEM_BYTES = (4, 5)
# Changes of a coordinate are added up as multiples of 2**-40, so that no order of slabs or tasks alters the sum.
_UNIT = 2.0**40


@dataclass(frozen=True)
class Ftrl:
    """Parameters of the learner, which goes through about `slab_rows` rows one after the other in each of its slabs.

    It is fitted on all labelled rows; a caller may set `most_rows` to bound those of each class.
    """

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.1
    epochs: int = 8
    most_rows: int | None = None
    slab_rows: int = 8000
    bits: int = BUCKET_BITS


@dataclass(frozen=True)
class Weights:
    """The fitted model: the buckets whose weight L1 left above or below zero. At most 2**bits of them."""

    buckets: np.ndarray
    values: np.ndarray
    bias: float
    bits: int

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << self.bits)
        out[self.buckets] = self.values
        return out


def _features(words: Words, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text of each) of single words and their stems, pairs of neighbours, and pairs with one word between."""
    shift, owner = np.uint64(64 - bits), words.owner()
    stems = [(mix(hashes + np.uint64(k + 1)), owner) for k, hashes in enumerate(words.stems)]
    for hashes, of in ((words.hashes, owner), *stems, words.grams(2), words.grams(2, skip=1)):
        yield (hashes >> shift).astype(np.int64), of


def _row_features(text_column: pa.Array, bits: int) -> Iterator[np.ndarray]:
    """The distinct buckets of each text."""
    for first, last, words in slices(text_column, ALPHANUMERIC, STEM_BYTES):
        parts = list(_features(words, bits))
        both = np.concatenate([owner * (1 << bits) + bucket for bucket, owner in parts])
        both = np.unique(both)
        owner, bucket = both >> bits, both & ((1 << bits) - 1)
        cuts = np.searchsorted(owner, np.arange(last - first + 1))
        for k in range(last - first):
            yield bucket[cuts[k] : cuts[k + 1]]


def _weights_of(z: np.ndarray, n: np.ndarray, p: Ftrl) -> np.ndarray:
    w = -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)
    return np.where(np.abs(z) <= p.l1, 0.0, w)


def _bias_of(z: float, n: float, p: Ftrl) -> float:
    return -z / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)


def _pass(rows: Iterable[tuple[np.ndarray, int]], z: np.ndarray, n: np.ndarray, p: Ftrl) -> None:
    """One pass of FTRL-proximal over rows, changing z and n in place. The last coordinate is the bias, without L1."""
    for buckets, label in rows:
        zi, ni = z[buckets], n[buckets]
        w = _weights_of(zi, ni, p)
        bias = _bias_of(z[-1], n[-1], p)
        score = 1.0 / (1.0 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
        g = score - label
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / p.alpha
        z[buckets] = zi + g - sigma * w
        n[buckets] = ni + g * g
        sigma = (np.sqrt(n[-1] + g * g) - np.sqrt(n[-1])) / p.alpha
        z[-1] += g - sigma * bias
        n[-1] += g * g


def training_rows(docs: DataFrame, labels: DataFrame, wanted: Column, p: Ftrl, doc_id: str, text: str) -> DataFrame:
    """doc, label, text, slab: the distinct texts of the labelled ids, dealt into slabs by a hash; each slab lies in one partition.

    With `most_rows`, of at most so many ids of each class, those of smallest hash.
    """
    known = (
        labels.filter(wanted & F.col("toxic").isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("doc"))
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
    )
    if p.most_rows is not None:
        order, all_known = F.xxhash64("doc", F.lit(7)), known
        known = all_known.filter("label = 1").orderBy(order, "doc").limit(p.most_rows)
        known = known.unionByName(all_known.filter("label = 0").orderBy(order, "doc").limit(p.most_rows))
    known = staged(known, "labelled")
    slabs = max(1, -(-known.count() // p.slab_rows))
    texts = docs.select(F.col(doc_id).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    slab = F.pmod(F.xxhash64("doc", "text", F.lit(13)), F.lit(slabs)).cast("int")
    rows = texts.join(bounded(known), "doc").withColumn("slab", slab)
    # More partitions than slabs, so that few have to hold several slabs at once.
    return rows.repartition(4 * slabs, "slab").dropDuplicates(["slab", "doc", "text"]).select("doc", "label", "text", "slab")


def _bounded(table: DataFrame, sizes: dict[int, int], most: int) -> DataFrame:
    """At most `most` rows of each label: ids with several texts may have brought more."""
    if max(sizes.values()) <= most:
        return table
    order = [F.xxhash64("doc", "buckets"), "doc", "buckets"]
    parts = [table.filter(F.col("label") == label).orderBy(*order).limit(most) for label in sorted(sizes)]
    return functools.reduce(DataFrame.unionByName, parts)


def _examples(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, int]]:
    """(slab, buckets, label) of every row."""
    for batch in batches:
        lists, slabs, labels = batch.column("buckets"), batch.column("slab").to_pylist(), batch.column("label").to_pylist()
        bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype(np.int64)
        for k, (slab, label) in enumerate(zip(slabs, labels)):
            yield slab, values[bounds[k] : bounds[k + 1]], label


def _in_slabs(table: DataFrame, order: list[Column | str]) -> DataFrame:
    """`table` stored as one file per slab, in this order.

    The buckets of a text ascend, so they are stored as differences, in half the space.
    """
    path = shared_path(table.sparkSession, "slabs")
    writer = table.sortWithinPartitions("slab", *order).drop("order").write.partitionBy("slab")
    writer.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false").parquet(path)
    return table.sparkSession.read.schema(table.drop("order").schema).parquet(path)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    wanted: Column,
    p: Ftrl = Ftrl(),
    *,
    doc_id: str = "doc_id",
    text: str = "text",
) -> Weights:
    """Fit on all labelled rows for which `wanted` holds, or as many as `p` asks for.

    The rows are dealt into slabs of one size, whatever their number. In each epoch every slab is passed by the sequential
    learner from the same state, all slabs in parallel; the next state is the mean of theirs by rows. One slab is plain FTRL. A
    slab of more than one Parquet row group may be passed in parts, each of which counts by its rows. Distinct texts
    of an id count once, however often they repeat. Without rows of both classes all weights are 0 and every text scores a half.
    """
    bits, size = p.bits, (1 << p.bits) + 1
    spark = docs.sparkSession

    def featurize(batches):
        for batch in batches:
            found = [x.astype(np.int32) for x in _row_features(batch.column("text"), bits)]
            kept = [batch.column(name) for name in ("doc", "label", "order", "slab")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(found, pa.list_(pa.int32()))], names=["doc", "label", "order", "slab", "buckets"]
            )

    order = [F.xxhash64("doc", F.lit(11)), "doc", "order"]
    rows = training_rows(docs, labels, wanted, p, doc_id, text).withColumn("order", F.xxhash64("text"))
    made = rows.mapInArrow(featurize, "doc bigint, label int, order bigint, slab int, buckets array<int>")
    table = _in_slabs(made.select("label", "buckets", "doc", "order", "slab"), order)
    sizes = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Weights(np.zeros(0, np.int64), np.zeros(0), 0.0, bits)
    if p.most_rows is not None and max(sizes.values()) > p.most_rows:
        fewer = _bounded(table, sizes, p.most_rows).repartition("slab")
        table = _in_slabs(fewer, [*order[:2], "buckets"])
        sizes = {r["label"]: r["count"] for r in table.groupBy("label").count().collect()}
    total = sum(sizes.values())
    # A task adds up the changes of its slabs before they are shuffled: a row per coordinate and task, however many slabs.
    examples = table.select("label", "buckets", "slab").coalesce(spark.sparkContext.defaultParallelism)

    z, n = np.zeros(size), np.zeros(size)
    for _ in range(p.epochs):
        sent = spark.sparkContext.broadcast((z, n))

        def passed(batches):
            z0, n0 = sent.value
            changed = np.zeros((2, size), np.int64)
            for _, rows in groupby(_examples(batches), key=lambda row: row[0]):
                z, n, count = z0.copy(), n0.copy(), 0

                def counted():
                    nonlocal count
                    for _, buckets, label in rows:
                        count += 1
                        yield buckets, label

                _pass(counted(), z, n, p)
                share = count / total * _UNIT
                changed += np.rint(np.stack([z - z0, n - n0]) * share).astype(np.int64)
            at = np.flatnonzero(changed.any(axis=0))
            for low in range(0, len(at), 1 << 16):
                own = at[low : low + (1 << 16)]
                yield pa.record_batch([pa.array(own), *[pa.array(c[own]) for c in changed]], names=["at", "z", "n"])

        changes = examples.mapInArrow(passed, "at bigint, z bigint, n bigint")
        # At most 2**bits + 1 rows.
        found = changes.groupBy("at").agg(F.sum("z").alias("z"), F.sum("n").alias("n")).toArrow()
        at = found["at"].to_numpy()
        z[at] += found["z"].to_numpy() / _UNIT
        n[at] += found["n"].to_numpy() / _UNIT
        sent.destroy()
    w, bias = _weights_of(z[:-1], n[:-1], p), _bias_of(z[-1], n[-1], p)
    at = np.flatnonzero(w)
    return Weights(at, w[at], float(bias), bits)


def score(docs: DataFrame, weights: Weights, *, text: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the probability that each whole text is toxic. NULL and empty texts get that of the bias alone."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    at = docs.columns.index(text)

    def scored(batches):
        dense = model.value.dense()
        bits, bias = model.value.bits, model.value.bias
        for batch in batches:
            logits = np.full(batch.num_rows, bias)
            for first, _, words in slices(batch.column(at), ALPHANUMERIC, STEM_BYTES):
                hits = []
                for bucket, owner in _features(words, bits):
                    found = np.flatnonzero(dense[bucket])
                    hits.append(owner[found] * (1 << bits) + bucket[found])
                both = np.unique(np.concatenate(hits))  # a text has a bucket or has it not
                np.add.at(logits, first + (both >> bits), dense[both & ((1 << bits) - 1)])
            p = 1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35)))
            yield batch.append_column(out, pa.array(p))

    return mapped(docs, scored, StructType.fromDDL(f"`{out}` double"))


def remove_toxic(docs: DataFrame, labels: DataFrame, wanted: Column, threshold: float = 0.7, **options) -> DataFrame:
    """The rows of `docs` that score below `threshold`; columns as they were."""
    own = "__toxic_score"
    scored = score(docs, fit(docs, labels, wanted, **options), out=own)
    return scored.filter(F.col(own) < threshold).drop(own)
