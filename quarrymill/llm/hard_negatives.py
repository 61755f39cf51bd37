"""Hard negatives by exact inner products, of which angles to reference directions rule out most."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import staged


@dataclass(frozen=True)
class Mining:
    """Parameters.

    Entries become floor(`scale` * c). An anchor's `positives` best rows of its label each look for `negatives` rows of other
    labels whose score is `low` to `high` percent of the positive's. `references` directions are chosen among `most_sampled` rows; any
    choice gives the same result. `block_rows` rows meet `visitors` anchors in a task, and anchors visit `growth` times as many blocks in each round.
    """

    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    references: int = 8
    most_sampled: int = 4096
    rings: int = 64
    block_rows: int = 16_384
    visitors: int = 16_384
    growth: int = 8
    seed: int = 29


# Angles from rounded cosines are off by less than this; scores from rounded angles by less than a share of the norms and a half.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
_ANY = 2**62


def usable(vectors: DataFrame, vec_id: str, label: str, vector: str, scale: int) -> DataFrame:
    """vec_id, label, x: each distinct row with an id, a label and a vector without NULL or non-finite components."""
    v = F.transform(vector, lambda c: c.cast("double"))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), v.alias("v"))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = rows.filter(fine).select("vec_id", "label", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))
    return whole.dropDuplicates()


def reference_directions(x: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors far from each other: the mean's direction, then whichever row is farthest from those chosen."""
    norms = np.linalg.norm(x, axis=1)
    rows = x[norms > 0] / norms[norms > 0][:, None]
    if not len(rows):
        return np.eye(x.shape[1])[:count]
    middle = rows.sum(axis=0)
    length = np.linalg.norm(middle)
    chosen = [middle / length if length > 1e-9 else rows[0]]
    nearest = rows @ chosen[0]
    while len(chosen) < min(count, len(rows) + 1):
        chosen.append(rows[int(np.argmin(nearest))])
        nearest = np.maximum(nearest, rows @ chosen[-1])
    return np.array(chosen)


def angles_to(x: np.ndarray, norms: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles between rows and references; a zero vector is at right angles to everything."""
    cosines = (x @ references.T) / np.where(norms > 0, norms, 1.0)[:, None]
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def score_bounds(
    own: np.ndarray, norm: float, low: np.ndarray, high: np.ndarray, norm_low: np.ndarray, norm_high: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of a vector at angles `own` with any whose angles are from `low` to `high`.

    Two directions at angles s and t from a third are at least |s - t| and at most s + t, or 2 pi - s - t, apart. With one row for `low` and
    `high` the vectors' angles are known; norms lie between `norm_low` and `norm_high`.
    """
    gap = np.maximum(low - own, own - high).max(axis=-1)
    reach = np.minimum(own + high, 2 * np.pi - own - low).min(axis=-1)
    most = np.cos(np.clip(gap - ANGLE_SLACK, 0.0, np.pi))
    least = np.cos(np.clip(reach + ANGLE_SLACK, 0.0, np.pi))
    greatest = norm * most * np.where(most > 0, norm_high, norm_low)
    smallest = norm * least * np.where(least > 0, norm_low, norm_high)
    slack = norm * norm_high * SCORE_SLACK + 0.5
    return smallest - slack, greatest + slack


def inner_products(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, as longs. In doubles, where every partial sum is exact in them."""
    most = float(np.abs(x).max(initial=0)) * float(np.abs(a).max(initial=0)) * max(1, len(a))
    if most < 2.0**53:
        return (x @ a).astype(np.int64)
    if most < 2.0**63:
        return x.astype(np.int64) @ a.astype(np.int64)
    raise OverflowError("a score does not fit a long")


# --- zones ------------------------------------------------------------------------------------


@dataclass
class Zones:
    """Rows of one length whose nearest reference and angle to it are alike, and bounds of their angles and norms."""

    dimension: np.ndarray
    cell: np.ndarray
    blocks: np.ndarray
    low: np.ndarray
    high: np.ndarray
    norm_low: np.ndarray
    norm_high: np.ndarray

    def order(self, dimension: int, own: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Zones of this length, most promising first, and the bounds of their scores."""
        zones = np.flatnonzero(self.dimension == dimension)
        smallest, greatest = score_bounds(
            own, norm, self.low[zones], self.high[zones], self.norm_low[zones], self.norm_high[zones]
        )
        order = np.lexsort((zones, -greatest))
        return zones[order], smallest[order], greatest[order]


def _located(rows: DataFrame, p: Mining) -> DataFrame:
    """The rows with their norm and angles, the nearest reference (`cell`) and how far from it they are (`ring`)."""
    sample = rows.orderBy(F.xxhash64("vec_id", F.lit(p.seed)), "vec_id").limit(p.most_sampled).select("x").toPandas()["x"]
    by_length: dict[int, list] = {}
    for value in sample:
        by_length.setdefault(len(value), []).append(np.asarray(value, float))
    references = {n: reference_directions(np.array(own), p.references) for n, own in by_length.items() if n}
    sent = rows.sparkSession.sparkContext.broadcast(references)

    def locate(batches):
        for batch in batches:
            x = batch.column("x")
            at, values = x.offsets.to_numpy(), x.values.to_numpy(zero_copy_only=False).astype(float)
            sizes = np.diff(at)
            angles, norms = np.full((len(sizes), p.references), np.pi / 2), np.zeros(len(sizes))
            for size in np.unique(sizes[sizes > 0]).tolist():
                own = np.flatnonzero(sizes == size)
                matrix = values[at[own][:, None] + np.arange(size)]
                norms[own] = np.linalg.norm(matrix, axis=1)
                directions = sent.value.get(size, np.eye(size)[: p.references])
                angles[own, : len(directions)] = angles_to(matrix, norms[own], directions)
                # Directions that are missing repeat the first: they rule nothing out.
                angles[own, len(directions) :] = angles[own, :1]
            cell = angles.argmin(axis=1)
            ring = np.minimum(angles.min(axis=1) * (p.rings / np.pi), p.rings - 1).astype(np.int32)
            flat = pa.array(angles.ravel())
            starts = pa.array(np.arange(0, len(flat) + 1, p.references, dtype=np.int32))
            columns = [pa.array(norms), pa.ListArray.from_arrays(starts, flat), pa.array(sizes.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(ring)]
            names = ["norm", "angles", "dimension", "cell", "ring"]
            yield pa.record_batch([*batch.columns, *columns], names=[*batch.schema.names, *names])

    label = rows.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {label}, x array<long>, norm double, angles array<double>, dimension int, cell int, ring int"
    return staged(rows.mapInArrow(locate, schema), "located")


def _zones(located: DataFrame, p: Mining) -> tuple[Zones, DataFrame]:
    """The zones, and which of them each (dimension, cell, ring) belongs to: at most `references * rings` a length."""
    ends = [f(F.col("angles")[k]).alias(f"{f.__name__}{k}") for f in (F.min, F.max) for k in range(p.references)]
    counted = located.groupBy("dimension", "cell", "ring").agg(
        F.count(F.lit(1)).alias("rows"), F.min("norm").alias("norm_low"), F.max("norm").alias("norm_high"), *ends
    )
    zones: list[dict] = []
    belongs = []
    for row in counted.orderBy("dimension", "cell", "ring").collect():
        low, high = (np.array([row[f"{f}{k}"] for k in range(p.references)]) for f in ("min", "max"))
        last = zones[-1] if zones else None
        if last and last["key"] == (row["dimension"], row["cell"]) and last["rows"] + row["rows"] <= p.block_rows:
            last["rows"] += row["rows"]
            last["low"], last["high"] = np.minimum(last["low"], low), np.maximum(last["high"], high)
            last["norms"] = min(last["norms"][0], row["norm_low"]), max(last["norms"][1], row["norm_high"])
        else:
            key = (row["dimension"], row["cell"])
            zones.append({"key": key, "rows": row["rows"], "low": low, "high": high, "norms": (row["norm_low"], row["norm_high"])})
        belongs.append((row["dimension"], row["cell"], row["ring"], len(zones) - 1))
    blocks = [-(-z["rows"] // p.block_rows) for z in zones]
    out = Zones(
        np.array([z["key"][0] for z in zones], int),
        np.array([z["key"][1] for z in zones], int),
        np.array(blocks, int),
        np.array([z["low"] for z in zones]),
        np.array([z["high"] for z in zones]),
        np.array([z["norms"][0] for z in zones]),
        np.array([z["norms"][1] for z in zones]),
    )
    listed = [(*place, blocks[place[3]]) for place in belongs]
    table = located.sparkSession.createDataFrame(listed, "dimension int, cell int, ring int, zone int, blocks int")
    return out, F.broadcast(table)


# --- the search -------------------------------------------------------------------------------

_FOUND = "anchor_id long, anchor long, target int, vec_id long, score long"


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(rows, -1)


class _Block:
    """Rows of a task, sorted by their angle to one reference."""

    def __init__(self, rows: pa.Table, cell: int):
        angles = _matrix(rows.column("angles"), rows.num_rows)
        order = np.argsort(angles[:, cell], kind="stable")
        self.angles, self.sorted_by = angles[order], angles[order, cell]
        self.x = np.ascontiguousarray(_matrix(rows.column("x"), rows.num_rows)[order])
        self.norms = rows.column("norm").to_numpy()[order]
        self.ids = rows.column("vec_id").to_numpy()[order]
        self.cell = cell

    def best(self, a: dict, low: np.ndarray, high: np.ndarray, k: int, allowed: np.ndarray | None):
        """(target, ids, scores): the `k` best rows for each target's scores from `low` to `high`."""
        first, last = 0, len(self.ids)
        if low.min() > 0:
            # Rows in reach are a window of the order by angle.
            near = (low.min() - 0.5) / max(a["norm"] * float(self.norms.max()), 1e-300) - SCORE_SLACK
            radius = np.arccos(np.clip(near, -1.0, 1.0)) + ANGLE_SLACK
            own = a["angles"][self.cell]
            first, last = np.searchsorted(self.sorted_by, [own - radius, own + radius])
        at = slice(int(first), int(last))
        if first >= last:
            return
        norms, angles = self.norms[at], self.angles[at]
        smallest, greatest = score_bounds(a["angles"], a["norm"], angles, angles, norms, norms)
        overlap = np.zeros(len(norms), bool)
        for one, other in zip(low, high):
            overlap |= (greatest >= one) & (smallest <= other)
        overlap &= self.ids[at] != a["id"]
        if allowed is not None:
            overlap &= allowed[at]
        rows = np.flatnonzero(overlap)
        if not len(rows):
            return
        window = self.x[at]
        score = inner_products(window, a["x"])[rows] if 8 * len(rows) > len(norms) else inner_products(window[rows], a["x"])
        ids = self.ids[at][rows]
        for target, (one, other) in enumerate(zip(low.tolist(), high.tolist())):
            fit = np.flatnonzero((score >= one) & (score <= other))
            if len(fit) > k:
                fit = fit[score[fit] >= np.partition(score[fit], len(fit) - k)[len(fit) - k]]
            if len(fit):
                fit = fit[np.lexsort((ids[fit], -score[fit]))[:k]]
                yield target, ids[fit], score[fit]


def _search_block(zones: Zones, same: bool, k: int):
    def search(key: tuple, rows: pa.Table, visitors: pa.Table) -> pa.Table:
        out: dict[str, list] = {"anchor_id": [], "anchor": [], "target": [], "vec_id": [], "score": []}
        if rows.num_rows and visitors.num_rows:
            cell = int(zones.cell[key[0].as_py()])
            labels = np.array(rows.column("label").to_pylist(), object)
            if same:
                blocks = {
                    value: _Block(rows.take(pa.array(np.flatnonzero(labels == value))), cell) for value in set(labels.tolist())
                }
            else:
                whole = _Block(rows, cell)
                order = np.argsort(_matrix(rows.column("angles"), rows.num_rows)[:, cell], kind="stable")
                others = {value: labels[order] != value for value in set(labels.tolist())}
            x, angles = _matrix(visitors.column("x"), visitors.num_rows), _matrix(visitors.column("angles"), visitors.num_rows)
            columns = (visitors.column(c).to_pylist() for c in ("vec_id", "anchor", "label", "norm", "low", "high", "target"))
            for n, (own, anchor, label, norm, low, high, targets) in enumerate(zip(*columns)):
                block = blocks.get(label) if same else whole
                if block is None:
                    continue
                a = {"id": own, "x": x[n], "norm": norm, "angles": angles[n]}
                for target, ids, scores in block.best(a, np.array(low), np.array(high), k, None if same else others.get(label)):
                    out["anchor_id"].append(np.full(len(ids), own))
                    out["anchor"].append(np.full(len(ids), anchor))
                    out["target"].append(np.full(len(ids), targets[target]))
                    out["vec_id"].append(ids)
                    out["score"].append(scores)
        kinds = {"target": np.int32}
        return pa.table({c: np.concatenate([*v, np.zeros(0, np.int64)]).astype(kinds.get(c, np.int64)) for c, v in out.items()})

    return search


def _best(found: DataFrame, k: int) -> DataFrame:
    """The `k` best of each anchor's target, ranked."""
    order = Window.partitionBy("anchor_id", "anchor", "target").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(dealt: DataFrame, zones: Zones, anchors: DataFrame, n_anchors: int, same: bool, k: int, p: Mining) -> DataFrame:
    """anchor_id, anchor, target, vec_id, score, rank: the `k` best rows of the anchor's label, or of other ones, for each target.

    `anchors` have `targets`, of (target, low, high). An anchor visits the blocks of rows whose scores can be in one of its targets, the most
    promising first: after each round, a target that has its `k` rows only asks for scores that would displace one of them, and the next
    round visits `growth` times as many blocks.
    """
    spark = dealt.sparkSession
    crowds = max(1, -(-n_anchors // p.visitors))
    sent = spark.sparkContext.broadcast(zones)
    shape = anchors.select("vec_id", "anchor", "label", "x", "norm", "angles", "dimension", "targets")
    kind = anchors.schema["label"].dataType.simpleString()
    visit = f"zone int, block int, vec_id long, anchor long, label {kind}, x array<long>, norm double, angles array<double>, target array<int>, low array<long>, high array<long>"

    def visits(start: int, stop: int):
        def work(batches):
            z = sent.value
            for batch in batches:
                zone, block, row, names, lows, highs = [], [], [], [], [], []
                angles = _matrix(pa.chunked_array([batch.column("angles")]), batch.num_rows)
                for n, (dimension, norm, targets) in enumerate(
                    zip(*(batch.column(c).to_pylist() for c in ("dimension", "norm", "targets")))
                ):
                    order, smallest, greatest = z.order(dimension, angles[n], norm)
                    ends = np.cumsum(z.blocks[order])
                    for at in range(int(np.searchsorted(ends, start, side="right")), len(order)):
                        begins = int(ends[at] - z.blocks[order[at]])
                        if begins >= stop:
                            break
                        fit = [t for t in targets if greatest[at] >= t["low"] and smallest[at] <= t["high"]]
                        if not fit:
                            continue
                        for number in range(max(start, begins), min(stop, int(ends[at]))):
                            zone.append(int(order[at]))
                            block.append(number - begins)
                            row.append(n)
                            names.append([t["target"] for t in fit])
                            lows.append([t["low"] for t in fit])
                            highs.append([t["high"] for t in fit])
                if not row:
                    continue
                own = batch.take(pa.array(row))
                yield pa.record_batch(
                    [
                        pa.array(zone, pa.int32()),
                        pa.array(block, pa.int32()),
                        *[own.column(c) for c in ("vec_id", "anchor", "label", "x", "norm", "angles")],
                        pa.array(names, pa.list_(pa.int32())),
                        pa.array(lows, pa.list_(pa.int64())),
                        pa.array(highs, pa.list_(pa.int64())),
                    ],
                    names=["zone", "block", "vec_id", "anchor", "label", "x", "norm", "angles", "target", "low", "high"],
                )

        return work

    every = F.sequence(F.lit(0), F.lit(crowds - 1))
    rows = dealt.select("zone", "block", "vec_id", "label", "x", "norm", "angles").withColumn("crowd", F.explode(every))
    most = max((int(zones.blocks[zones.dimension == d].sum()) for d in set(zones.dimension.tolist())), default=0)
    found, start, stop = None, 0, 1
    while start < most:
        visitors = shape.mapInArrow(visits(start, stop), visit).withColumn(
            "crowd", F.pmod(F.xxhash64("vec_id", "anchor", F.lit(p.seed)), F.lit(crowds)).cast("int")
        )
        keys = ["zone", "block", "crowd"]
        met = rows.groupBy(*keys).cogroup(visitors.groupBy(*keys)).applyInArrow(_search_block(zones, same, k), _FOUND)
        met = met if found is None else met.unionByName(found.drop("rank"))
        found = staged(_best(met, k), "found")
        start, stop = stop, stop + (stop - start) * p.growth
        if start < most:
            full = found.filter(F.col("rank") == k).select("anchor_id", "anchor", "target", F.col("score").alias("floor"))
            floors = full.groupBy("anchor_id", "anchor").agg(F.map_from_entries(F.collect_list(F.struct("target", "floor"))).alias("floors"))
            joined = anchors.join(floors.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "anchor"], "left")
            # Of equal scores the smaller id counts, so a score that only equals the last one may still displace it.
            raised = F.transform(
                "targets",
                lambda t: F.struct(
                    t["target"].alias("target"),
                    F.greatest(t["low"], F.coalesce(F.col("floors")[t["target"]], t["low"])).alias("low"),
                    t["high"].alias("high"),
                ),
            )
            shape = joined.withColumn("targets", raised).select(*shape.columns)
    return spark.createDataFrame([], _FOUND + ", rank int") if found is None else found


def mine(
    vectors: DataFrame,
    is_anchor: Callable[[Column], Column],
    p: Mining = Mining(),
    *,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
) -> DataFrame:
    """For each anchor and each of its best rows of the same label, the hardest rows of other labels.

    A row's score is the inner product of its whole-number vector with the anchor's; larger ones come first, then smaller ids. The
    positives of an anchor are its first `positives` other rows of its label; its negatives for a positive are the first rows of other labels with
    a score of `low` to `high` percent of the positive's. Returns `anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`; all, where there are fewer.

    The method: every row's angles to reference directions are stored. By the triangle inequality on the sphere they bound the angle
    to an anchor from both sides; times the norms, and with room for rounding, they bound the score. Whole zones of rows whose bounds miss all of
    an anchor's targets are not visited, and in a block that is visited only rows whose bounds overlap a target are scored, in whole
    numbers. Rows are dealt to blocks of bounded size and anchors to crowds of bounded size, so that a third of all rows
    may be one vector; the rows found are merged by anchor, round after round.

    Rows without an id, a label or a vector, or with a NULL or non-finite component, take no part. Rows that repeat in full count once; rows that share
    only their id are rows of their own, though never of each other. Vectors are compared with those of their length only. A
    zero vector scores 0. An anchor without positives, or a negative positive score, gives no row, as does an empty table. Scores beyond a
    long are an error.
    """
    rows = usable(vectors, vec_id, label, vector, p.scale)
    located = _located(rows, p)
    zones, belongs = _zones(located, p)
    dealt = located.join(belongs, ["dimension", "cell", "ring"]).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", "label", "x"), F.col("blocks")).cast("int")
    )
    dealt = staged(dealt, "dealt")
    anchors = dealt.filter(is_anchor(F.col("vec_id"))).withColumn("anchor", F.xxhash64("label", "x"))
    n_anchors = anchors.count()

    def target(number, low, high):
        return F.struct(number.cast("int").alias("target"), low.cast("long").alias("low"), high.cast("long").alias("high"))

    whole = F.array(target(F.lit(0), F.lit(-_ANY), F.lit(_ANY)))
    positives = _search(dealt, zones, anchors.withColumn("targets", whole), n_anchors, True, p.positives, p)
    positives = positives.select("anchor_id", "anchor", F.col("rank").alias("target"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    # low * s <= 100 * t <= high * s in whole numbers; no score is between them for s < 0.
    least, most = F.expr(f"({p.low} * positive_score + 99) div 100"), F.expr(f"{p.high} * positive_score div 100")
    sought = positives.filter("positive_score >= 0").groupBy("anchor_id", "anchor").agg(
        F.collect_list(target(F.col("target"), least, most)).alias("targets")
    )
    seeking = anchors.join(sought.withColumnRenamed("anchor_id", "vec_id"), ["vec_id", "anchor"])
    negatives = _search(dealt, zones, seeking, n_anchors, False, p.negatives, p)
    return negatives.join(positives, ["anchor_id", "anchor", "target"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
