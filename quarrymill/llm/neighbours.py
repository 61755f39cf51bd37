"""Approximate nearest neighbours: balanced posting lists with replicas, a graph over centroids, pruned by distance."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import staged


@dataclass(frozen=True)
class Index:
    """Parameters of the index.

    `most_sampled` vectors fit the centroids; every vector is indexed. `list_rows` is how many a list should
    hold, `most_lists` bounds the centroids that are broadcast. A vector is also put on lists whose centroid is at
    most `boundary` times as far as the nearest, up to `replicas`. A query visits all lists whose centroid is at most
    `reach` times as far as the nearest, however many they are; its walk over the graph of centroids also goes through
    the `beam` nearest ones, so that it gets past gaps. Lists of more than `block_rows` rows are dealt to several tasks.
    """

    most_sampled: int = 20_000
    list_rows: int = 400
    most_lists: int = 1024
    rounds: int = 10
    boundary: float = 1.05
    replicas: int = 3
    reach: float = 1.35
    degree: int = 16
    beam: int = 64
    block_rows: int = 5_000
    seed: int = 17


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _gaps(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Euclidean distances of unit vectors."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ centroids.T), 0.0))


def balanced_centroids(x: np.ndarray, lists: int, p: Index) -> np.ndarray:
    """Centroids of about equally many of the unit vectors `x`: a list that is too full looks farther away."""
    lists = max(1, min(lists, len(x)))
    rng = np.random.default_rng(p.seed)
    centroids = x[rng.choice(len(x), lists, replace=False)].copy()
    load = np.ones(lists)
    for _ in range(p.rounds):
        nearest = np.argmin(_gaps(x, centroids) * np.sqrt(np.clip(load, 0.5, 2.0)), axis=1)
        sizes = np.bincount(nearest, minlength=lists)
        load = 0.5 * load + 0.5 * sizes * lists / len(x)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        full = np.linalg.norm(sums, axis=1) > 1e-12
        centroids[full] = unit(sums[full])
        empty = np.flatnonzero(~full)
        centroids[empty] = x[rng.choice(len(x), len(empty))]
    return centroids


class CentroidGraph:
    """Each centroid linked to its nearest ones, both ways; a best-first walk finds those nearest to a query."""

    def __init__(self, centroids: np.ndarray, degree: int):
        self.centroids = centroids
        gaps = _gaps(centroids, centroids)
        nearest = np.argsort(gaps, axis=1, kind="stable")[:, : degree + 1]
        links = [set(row) - {k} for k, row in enumerate(nearest.tolist())]
        for k, row in enumerate(nearest.tolist()):
            for other in row:
                if other != k:
                    links[other].add(k)
        # A ring keeps the graph in one piece.
        for k in range(len(centroids)):
            links[k].add((k + 1) % len(centroids))
        self.links = [np.array(sorted(own)) for own in links]
        middle = unit(centroids.sum(axis=0, keepdims=True) + 1e-12)
        self.entry = int(np.argmin(_gaps(middle, centroids)))

    def search(self, query: np.ndarray, beam: int, reach: float) -> np.ndarray:
        """The centroids at most `reach` times as far as the nearest, found by way of them and the `beam` nearest."""
        gaps = np.full(len(self.centroids), np.inf)
        passed = np.zeros(len(gaps), bool)
        gaps[self.entry] = _gaps(query[None, :], self.centroids[[self.entry]])[0, 0]
        while True:
            seen = gaps[gaps < np.inf]
            far = seen.min() * reach + 1e-12
            width = np.partition(seen, beam - 1)[beam - 1] if len(seen) > beam else np.inf
            front = np.flatnonzero(~passed & (gaps < np.inf) & (gaps <= max(far, width)))
            if not len(front):
                return np.flatnonzero(gaps <= far)
            # The nearest go first, as they bring down what counts as far.
            front = front[np.argsort(gaps[front], kind="stable")[: max(beam, len(seen) // 2)]]
            passed[front] = True
            new = np.unique(np.concatenate([self.links[k] for k in front]))
            new = new[gaps[new] == np.inf]
            if len(new):
                gaps[new] = _gaps(query[None, :], self.centroids[new])[0]


def enough(query: np.ndarray, found: np.ndarray, centroids: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """`found` if these lists are home to more than `k` ids, else the nearest lists that are, or all lists."""
    if ids[found].sum() > k:
        return found
    order = np.argsort(_gaps(query[None, :], centroids)[0], kind="stable")
    more = order[: int(np.searchsorted(np.cumsum(ids[order]), k + 1)) + 1]
    return np.union1d(found, more)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, v: rows with an id and a vector that is not zero, without NULL or non-finite components."""
    v = F.transform(vector, lambda x: x.cast("double"))
    rows = vectors.select(F.col(vec_id).alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(fine & F.exists("v", lambda x: x != 0.0))


def _stacked(values: pd.Series) -> np.ndarray:
    return np.stack(values.to_numpy()).astype(np.float64)


def _cosines(query: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, so that equal vectors get equal scores wherever they stand."""
    return (x * query).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((query * query).sum()))


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 5,
    p: Index = Index(),
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The `k` rows with the largest cosine found for each query row, its own id left out.

    The method: centroids of balanced lists are fitted on a bounded sample; every vector goes to its nearest
    list and, near a boundary, to further ones. A query finds the nearest centroids by a walk over a graph of them and
    visits all lists that are not too much farther than the nearest, and further ones until they hold `k` other ids. Lists are blocks of bounded size, of
    which a task scores one against its visitors and returns `k` of each; the blocks' results are merged by query.
    A third of all rows may be one vector: it fills many blocks of a list, never one task.

    Returns `query_id, rank, vec_id, score`; ties go to the smaller id. Vectors that are NULL, zero, or hold NULL or
    non-finite components take no part, nor do those of another length than most. Rows that repeat an id count
    as one with the best of their scores.
    """
    spark = vectors.sparkSession
    good = usable(vectors, vec_id, vector)
    lengths = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not lengths:
        return spark.range(0).selectExpr("id AS query_id", "int(id) AS rank", "id AS vec_id", "double(id) AS score")
    dimension, total = lengths[0]["d"], lengths[0]["count"]
    good = good.filter(F.size("v") == dimension)

    sample = good.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(p.most_sampled).toPandas()
    lists = int(min(p.most_lists, max(1, total // p.list_rows)))
    centroids = balanced_centroids(unit(_stacked(sample["v"])), lists, p)
    sent = spark.sparkContext.broadcast((centroids, CentroidGraph(centroids, p.degree)))

    def post(frames):
        points = sent.value[0]
        for frame in frames:
            if not len(frame):
                continue
            gaps = _gaps(unit(_stacked(frame["v"])), points)
            most = min(p.replicas, gaps.shape[1])
            near = np.argpartition(gaps, most - 1, axis=1)[:, :most]
            own = np.take_along_axis(gaps, near, 1)
            row, column = np.nonzero(own <= own.min(axis=1, keepdims=True) * p.boundary + 1e-12)
            yield pd.DataFrame(
                {
                    "list": near[row, column].astype(np.int32),
                    "vec_id": frame["vec_id"].to_numpy()[row],
                    "v": frame["v"].to_numpy()[row],
                    "home": column == own.argmin(axis=1)[row],
                }
            )

    posting = "list int, vec_id long, v array<double>"
    posted = staged(good.mapInPandas(post, f"{posting}, home boolean"), "postings")
    # At most `most_lists` rows: how many ids are at home on each list, where each id is counted once.
    homes = posted.filter("home").groupBy("vec_id").agg(F.min("list").alias("list")).groupBy("list").count().toPandas()
    at_home = np.zeros(len(centroids), np.int64)
    at_home[homes["list"].to_numpy(np.int64)] = homes["count"]

    def visit(frames):
        points, graph = sent.value
        for frame in frames:
            if not len(frame):
                continue
            listed, row = [], []
            for at, x in enumerate(unit(_stacked(frame["v"]))):
                found = enough(x, graph.search(x, p.beam, p.reach), points, at_home, k)
                listed.append(found)
                row.append(np.full(len(found), at))
            row = np.concatenate(row)
            yield pd.DataFrame(
                {
                    "list": np.concatenate(listed).astype(np.int32),
                    "vec_id": frame["vec_id"].to_numpy()[row],
                    "v": frame["v"].to_numpy()[row],
                }
            )

    # At most `most_lists` rows: how many blocks each list has.
    blocks = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / p.block_rows).cast("int").alias("blocks"))
    blocks = F.broadcast(staged(blocks, "blocks"))
    dealt = posted.join(blocks, "list").withColumn(
        "block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int")
    )
    visits = good.filter(is_query(F.col("vec_id"))).mapInPandas(visit, posting).join(blocks, "list")
    visits = visits.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def scored(rows: pd.DataFrame, visitors: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(rows) and len(visitors):
            rows = rows.sort_values("vec_id", kind="stable")
            x = _stacked(rows["v"])
            ids, first = np.unique(rows["vec_id"].to_numpy(), return_index=True)
            for query, value in zip(visitors["vec_id"], visitors["v"]):
                score = np.maximum.reduceat(_cosines(np.asarray(value, float), x), first)
                score[ids == query] = -np.inf
                best = [at for at in np.lexsort((ids, -score))[:k] if score[at] > -np.inf]
                out["query_id"] += [query] * len(best)
                out["vec_id"] += ids[best].tolist()
                out["score"] += score[best].tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    found = (
        dealt.select("list", "block", "vec_id", "v")
        .groupBy("list", "block")
        .cogroup(visits.select("list", "block", "vec_id", "v").groupBy("list", "block"))
        .applyInPandas(scored, "query_id long, vec_id long, score double")
    )
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(by_query))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
