"""Whitening of embeddings by incremental eigendecompositions that are merged and refined over all rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import staged
from quarrymill.llm.rank_one import Spectrum

# Entries become whole 64ths, moved by a million.
SCALE, SHIFT = 64, 1_000_000
# Partial results that one task merges.
FAN_IN = 16
# A direction with at most this share of the whole variance has none that could be scaled to one.
NO_VARIANCE = 1e-12

_PARTIAL = "dimension int, part long, n long, mean array<double>, matrix array<double>"


def whole_entries(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, x: rows without NULL or non-finite entries, `x` as longs."""
    v = F.transform(vector, lambda c: c.cast("double"))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).filter("v IS NOT NULL")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(fine).select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long")).alias("x"))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and the matrix of their vectors, for each length of vector in the batch."""
    x = batch.column("x")
    at = x.offsets.to_numpy()
    values = x.values.to_numpy(zero_copy_only=False)
    sizes = np.diff(at)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield rows, values[at[rows][:, None] + np.arange(size)] if size else np.zeros((len(rows), 0), np.int64)


def _folded(partial: DataFrame, fold: Callable[[pd.DataFrame], pd.DataFrame], name: str) -> DataFrame:
    """One row per dimension: partial results merged `FAN_IN` at a time, round after round."""
    partial = staged(partial, name)
    while (partial.agg(F.max("part")).first()[0] or 0) > 0:
        grouped = partial.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy("dimension", "part")
        partial = staged(grouped.applyInPandas(fold, _PARTIAL), name)
    return partial


def _row(dimension: int, part: int, n: int, mean: np.ndarray, matrix: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame([{"dimension": dimension, "part": part, "n": n, "mean": mean, "matrix": matrix.ravel()}])


_ARROW = pa.schema(
    [
        ("dimension", pa.int32()),
        ("part", pa.int64()),
        ("n", pa.int64()),
        ("mean", pa.list_(pa.float64())),
        ("matrix", pa.list_(pa.float64())),
    ]
)


def _batch(frame: pd.DataFrame) -> pa.RecordBatch:
    return pa.RecordBatch.from_pandas(frame, _ARROW, preserve_index=False)


def _spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The eigendecomposition of a partition's rows, one centred rank-one update each."""
    own: dict[int, Spectrum] = {}
    for batch in batches:
        for _, x in _matrices(batch):
            spectrum = own.setdefault(x.shape[1], Spectrum.empty(x.shape[1]))
            for row in (x - SHIFT).astype(float):
                spectrum.add(row)
    part = TaskContext.get().partitionId()
    for dimension, s in own.items():
        if dimension:
            # Eigenvalues are kept as a first row above the vectors.
            yield _batch(_row(dimension, part, s.n, s.mean, np.vstack([s.values, s.vectors])))


def _spectrum(row) -> Spectrum:
    matrix = np.asarray(row.matrix, float).reshape(-1, row.dimension)
    return Spectrum(int(row.n), np.asarray(row.mean, float), matrix[0], matrix[1:])


def _merged_spectra(rows: pd.DataFrame) -> pd.DataFrame:
    each = [_spectrum(row) for row in rows.itertuples()]
    for other in each[1:]:
        each[0].merge(other)
    s = each[0]
    return _row(rows.dimension.iloc[0], rows.part.iloc[0], s.n, s.mean, np.vstack([s.values, s.vectors]))


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    mean = np.sum([np.asarray(m, float) for m in rows["mean"]], axis=0)
    matrix = np.sum([np.asarray(m, float) for m in rows["matrix"]], axis=0)
    return _row(rows.dimension.iloc[0], rows.part.iloc[0], int(rows.n.sum()), mean, matrix)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, exact before the division wherever it fits a long."""
    y, s = x - SHIFT, sums - n * SHIFT
    if len(y) and n * float(np.abs(y).max(initial=0)) + float(np.abs(s).max(initial=0)) > 2.0**62:
        return y.astype(float) - s.astype(float) / n
    return (n * y - s) / n


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """The squared distance of n * x from the sums, exact; beyond a long it is an error."""
    largest = n * float(np.abs(x - SHIFT).max(initial=0)) + float(np.abs(sums - n * SHIFT).max(initial=0))
    if largest**2 * max(1, x.shape[1]) < 2.0**62:
        far = n * (x - SHIFT) - (sums - n * SHIFT)
        return (far * far).sum(axis=1)
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    if max(exact) >= 2**63:
        raise OverflowError("a deviation does not fit a long")
    return np.array(exact, np.int64)


def _products(of: dict[int, tuple], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the projected rows and of their products, around `middle`, per partition."""
    own: dict[int, tuple] = {}
    for batch in batches:
        for _, x in _matrices(batch):
            dimension = x.shape[1]
            if dimension not in of:
                continue
            n, sums, basis, middle = of[dimension]
            projected = _centred(x, n, sums) @ basis - middle
            rows, total, product = own.get(dimension, (0, 0.0, 0.0))
            own[dimension] = rows + len(x), total + projected.sum(axis=0), product + projected.T @ projected
    part = TaskContext.get().partitionId()
    for dimension, (rows, total, product) in own.items():
        yield _batch(_row(dimension, part, rows, total, product))


def _projected_covariance(rows: DataFrame, of: dict[int, tuple], name: str) -> dict[int, tuple]:
    """Per dimension the mean and covariance of the rows on a basis, over all of them."""
    sent = rows.sparkSession.sparkContext.broadcast(of)
    partial = rows.mapInArrow(lambda batches: _products(sent.value, batches), _PARTIAL)
    out = {}
    for row in _folded(partial, _summed, name).collect():
        width = len(row["mean"])
        out[row["dimension"]] = np.array(row["mean"]) / row["n"], np.array(row["matrix"]).reshape(width, width) / row["n"]
    return out


def whiten(vectors: DataFrame, components: int = 32, *, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Every row on the leading principal components, each scaled to variance one.

    The method: each partition keeps an eigendecomposition of its rows up to date by centred rank-one updates, whose secular
    equations are solved with deflation (`rank_one`). The spectra are merged by rank-one updates again, `FAN_IN` at a time. The result
    is a basis, in which the covariance of all rows is then computed in a distributed pass (Rayleigh-Ritz): its eigenvectors are those of the covariance to double
    precision, whatever rounding the updates have gathered. The driver sees one matrix per length of vector, never rows.

    Returns a row per remaining row and component: `vec_id, component` (from 1, by falling variance), `n`, `deviation` (the squared distance of
    n * x from the sums, exact), `whitened`, `explained` (share of the whole variance) and `identity_error` (the largest entry of
    the covariance of what is returned minus the identity, over all rows). `x` is floor(64 c) + 1,000,000 of each entry.

    Rows whose vector is NULL or has a NULL or non-finite entry are left out. Vectors of several lengths are whitened each among their own.
    A component without variance (few rows, equal rows) cannot be scaled and is left out, so a single row gives none. Rows that repeat count
    as often as they occur; a NULL id stays NULL. A deviation or entry beyond a long is an error. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = staged(whole_entries(vectors, vec_id, vector), "whole-entries")
    entries = rows.select(F.size("x").alias("dimension"), F.posexplode("x")).groupBy("dimension", "pos")
    # One row per length of vector and place.
    totals = entries.agg(F.sum("col").alias("s"), F.count(F.lit(1)).alias("n")).orderBy("dimension", "pos").collect()
    sums: dict[int, np.ndarray] = {}
    for dimension in {row["dimension"] for row in totals}:
        sums[dimension] = np.array([row["s"] for row in totals if row["dimension"] == dimension], np.int64)
    counts = {row["dimension"]: row["n"] for row in totals}

    bases = {}
    for row in _folded(rows.mapInArrow(_spectra, _PARTIAL), _merged_spectra, "spectra").collect():
        dimension = row["dimension"]
        matrix = np.array(row["matrix"]).reshape(-1, dimension)
        basis, _ = np.linalg.qr(matrix[1:][:, ::-1])
        bases[dimension] = (counts[dimension], sums[dimension], basis, np.zeros(dimension))
    models = {}
    for dimension, (mean, covariance) in _projected_covariance(rows, bases, "refined").items():
        n, s, basis, _ = bases[dimension]
        values, turn = np.linalg.eigh(covariance - np.outer(mean, mean))
        trace = float(np.trace(covariance - np.outer(mean, mean)))
        first = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > NO_VARIANCE * trace]
        axes = basis @ turn[:, first]
        axes *= np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(first))])
        scaled = axes / np.sqrt(values[first])
        # Only rounding moves the mean from zero; what is returned is measured around it.
        middle = mean @ turn[:, first] / np.sqrt(values[first])
        if first:
            models[dimension] = (n, s, scaled, middle, values[first] / trace)
    about = {d: model[:4] for d, model in models.items()}
    errors = {
        d: float(np.abs(covariance - np.eye(len(covariance))).max())
        for d, (_, covariance) in _projected_covariance(rows, about, "whitened-covariance").items()
    }
    sent = spark.sparkContext.broadcast({d: (*models[d], errors[d]) for d in errors})

    def project(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for at, x in _matrices(batch):
                if x.shape[1] not in sent.value:
                    continue
                n, s, scaled, _, explained, error = sent.value[x.shape[1]]
                k = scaled.shape[1]
                yield pa.record_batch(
                    [
                        ids.take(pa.array(np.repeat(at, k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(at) * k, n, np.int64)),
                        pa.array(np.repeat(_deviation(x, n, s), k)),
                        pa.array((_centred(x, n, s) @ scaled).ravel()),
                        pa.array(np.tile(explained, len(at))),
                        pa.array(np.full(len(at) * k, error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(
        project,
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double",
    )
