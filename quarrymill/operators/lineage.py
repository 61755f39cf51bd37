"""Questions about a dependency graph held as an edge table `(upstream, downstream)`."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarrymill.operators.skew import own_shuffle
from quarrymill.session import remove_folder, shared_dir

# Levels of a search that are searched one by one before what is left of the graph is contracted.
_LEVELS_APART = 6
# One in so many nodes of a chain is a stop, by a hash of its id.
_BETWEEN_STOPS = 16


def graph_ancestors(
    edges: DataFrame, start: DataFrame, id_col: str = "id", edges_are_stored: bool = False
) -> DataFrame:
    """Everything the start nodes depend on, directly or not, and the start nodes themselves."""
    steps = edges.select(F.col("downstream").alias("near"), F.col("upstream").alias("far"))
    return _reach(steps, start, id_col, edges_are_stored)


def graph_descendants(
    edges: DataFrame, start: DataFrame, id_col: str = "id", edges_are_stored: bool = False
) -> DataFrame:
    """Everything that depends on the start nodes, directly or not, and the start nodes themselves."""
    steps = edges.select(F.col("upstream").alias("near"), F.col("downstream").alias("far"))
    return _reach(steps, start, id_col, edges_are_stored)


class Scratch:
    """Tables of one search in the shared folder. Each cuts the lineage and survives lost executors."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.tables = spark, f"{shared_dir(spark)}/reach_{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame) -> tuple[DataFrame, int, str]:
        """The rows read back, their number, and where they are."""
        seen, path = Observation(), f"{self.folder}/{self.tables}"
        self.tables += 1
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        return self.read(df, path), seen.get["rows"], path

    def write_counting(self, df: DataFrame, mark: str) -> tuple[DataFrame, int]:
        """The rows read back without the column `mark`, and in how many it is true."""
        seen, path = Observation(), f"{self.folder}/{self.tables}"
        self.tables += 1
        df.observe(seen, F.count_if(F.col(mark)).alias("marked")).drop(mark).write.parquet(path)
        return self.read(df.drop(mark), path), seen.get["marked"]

    def read(self, like: DataFrame, *paths: str) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(*paths)

    def keep_only(self, paths: list[str]) -> None:
        for number in range(self.tables):
            if (path := f"{self.folder}/{number}") not in paths:
                remove_folder(self.spark, path)


def _reach(steps: DataFrame, start: DataFrame, id_col: str, stored: bool) -> DataFrame:
    """What the start nodes lead to, in a number of rounds that grows with the logarithm of the length of chains.

    A few levels are searched one by one from the newest nodes, which is all that most graphs need; cycles end by themselves. The levels'
    true sizes let Catalyst broadcast a small frontier, so that the edges are only scanned. What is left of a
    deeper graph is then contracted (`_contracted`), and the search goes on in what remains of it; at the end,
    nodes that were taken out are reached if a node they hang on is. A frontier holds each node once, so a node with very many
    edges makes the edge side of the join skewed, which Spark splits at run time.

    The edges are read once per round, so computed ones are stored first; pass `edges_are_stored` for a plain table. Only the folders
    that the result is read from are left behind.
    """
    spark = steps.sparkSession
    scratch = Scratch(spark)
    steps = steps.filter("near is not null and far is not null")
    if not stored:
        steps, _, _ = scratch.write(steps)
    newest, rows, path = scratch.write(start.select(F.col(id_col).alias("id")).filter("id is not null").distinct())
    levels, hanging = [path], []
    while rows:
        for _ in range(_LEVELS_APART):
            seen = scratch.read(newest, *levels)
            reached = steps.join(newest, steps["near"] == newest["id"]).select(F.col("far").alias("id"))
            newest, rows, path = scratch.write(reached.distinct().join(seen, "id", "left_anti"))
            if not rows:
                break
            levels.append(path)
        if rows:
            seen, _, path = scratch.write(scratch.read(newest, *levels))
            levels = [path]
            # Edges out of the newest nodes, and among those that have not been reached.
            known = seen.select(F.col("id").alias("far"))
            passed = seen.join(newest, "id", "left_anti").select(F.col("id").alias("near"))
            left = steps.join(known, "far", "left_anti").join(passed, "near", "left_anti").select("near", "far").distinct()
            steps = _contracted(scratch, left, newest, hanging)
    for taken_out in reversed(hanging):
        seen = scratch.read(start.select(F.col(id_col).alias("id")), *levels)
        found = taken_out.join(seen.withColumnRenamed("id", "head"), "head", "left_semi").select("id").distinct()
        _, _, path = scratch.write(found)
        levels.append(path)
    scratch.keep_only(levels)
    return scratch.read(start.select(F.col(id_col).alias("id")), *levels)


def _jumped(scratch: Scratch, heads: DataFrame, links: int, jumps: int, passed: Column | None = None) -> DataFrame:
    """(id, head) with every pointer moved on until its head has no pointer, or none that is to be `passed`.

    Pointers reach `jumps` + 1 times as far each round. Those that have come to their end take no further part; others still jump over them.
    Pointers that have found no end when they reach over all links are on closed cycles, which nothing leads into.
    """
    ended, moving, left, reach = [], heads, links, 1
    while left and reach <= links:
        known = reduce(DataFrame.unionByName, [*ended, moving])
        over = known if passed is None else known.filter(passed)
        over = over.select(F.col("id").alias("head"), F.col("head").alias("next"))
        found = moving
        for _ in range(jumps):
            found = found.select("id", "head").join(over, "head", "left")
            found = found.select("id", F.coalesce("next", "head").alias("head"), F.col("next").isNotNull().alias("on"))
        found, left = scratch.write_counting(found.withColumn("far_on", F.col("on")), "far_on")
        ended.append(found.filter("NOT on").select("id", "head"))
        moving = found.filter("on").select("id", "head")
        reach *= jumps + 1
    return reduce(DataFrame.unionByName, [*ended, moving])


def _contracted(scratch: Scratch, edges: DataFrame, newest: DataFrame, hanging: list[DataFrame]) -> DataFrame:
    """Fewer edges that lead from `newest` to the same places, without leaves and without the inner nodes of chains.

    Edges out of nodes that no edge leads to are left out, unless they begin at `newest`, which no edge leads to either.
    What is taken out goes to `hanging` as (id, head): `id` is reached exactly if one of its heads is. Leaves hang on the nodes that lead to them. A node
    with one edge in and one out hangs on the nearest node before it that is none, which pointers find that
    jump over each other (`_jumped`). Repeated while it takes out a quarter of the edges, as leaves gone make new chains.
    """
    edges, many, _ = scratch.write(edges)
    begin = newest.select(F.col("id").alias("near"))
    while many:
        led_to = edges.select(F.col("far").alias("near")).unionByName(begin).distinct()
        edges = edges.join(led_to, "near", "left_semi")
        goes_on = edges.select(F.col("near").alias("far")).distinct()
        leaves, _, _ = scratch.write(
            edges.join(goes_on, "far", "left_anti").select(F.col("far").alias("id"), F.col("near").alias("head"))
        )
        hanging.append(leaves)
        inner = edges.join(goes_on, "far", "left_semi").select("near", "far")
        out = inner.groupBy(F.col("near").alias("id")).agg(F.count(F.lit(1)).alias("out"))
        into = inner.groupBy(F.col("far").alias("id")).agg(F.count(F.lit(1)).alias("into"), F.min("near").alias("head"))
        chain = into.filter("into = 1").join(out.filter("out = 1"), "id")
        chain, links, _ = scratch.write(chain.select("id", "head"))
        heads = chain
        if links:
            # First to the nearest stop before each node, then from stop to stop: few pointers have a long way.
            stop = F.pmod(F.xxhash64("id"), F.lit(_BETWEEN_STOPS)) == 0
            near_stop = _jumped(scratch, chain, links, 3, ~stop)
            last = _jumped(scratch, near_stop.filter(stop), links, 5).select(F.col("id").alias("head"), F.col("head").alias("last"))
            heads, _, _ = scratch.write(near_stop.join(last, "head", "left").select("id", F.coalesce("last", "head").alias("head")))
            ends = chain.select(F.col("id").alias("head"))
            hanging.append(heads.join(ends, "head", "left_anti").select("id", "head"))
        shortened = (
            inner.join(chain.select(F.col("id").alias("far")), "far", "left_anti")
            .join(heads.select(F.col("id").alias("near"), "head"), "near", "left")
            .select(F.coalesce("head", "near").alias("near"), "far")
        )
        edges, left, _ = scratch.write(shortened.distinct())
        if 4 * left > 3 * many:
            return edges
        many = left
    return edges


MOST_SELECTIONS = 64


def reach_many(
    edges: DataFrame, starts: DataFrame, upstream: bool = False, id_col: str = "id", edges_are_stored: bool = False
) -> DataFrame:
    """(selection, id) of everything each of several selections leads to, by one search for all of them.

    `starts` has rows of (selection, id), with selections numbered from 0 to 63. A node carries a bit per selection that has reached it. Each
    round sends on only the bits that are new to a node; they are or-ed map-side, so that a node which many edges lead to is a row per
    task, and the edges are read once a level for all selections together. Computed edges are stored first, unless `edges_are_stored`; an edge
    that comes twice changes nothing. The start nodes belong to their selections.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark)
    near, far = ("downstream", "upstream") if upstream else ("upstream", "downstream")
    steps = edges.filter("upstream is not null and downstream is not null")
    steps = steps.select(F.col(near).alias("near"), F.col(far).alias("far"))
    if not edges_are_stored:
        steps, _, _ = scratch.write(steps)
    wrong = ~F.coalesce(F.col("selection").between(0, MOST_SELECTIONS - 1), F.lit(False))
    bit = F.when(wrong, F.raise_error(F.lit(f"selections are numbered from 0 to {MOST_SELECTIONS - 1}"))).otherwise(
        F.expr("shiftleft(1L, int(selection))")
    )
    begin = starts.select(F.col(id_col).alias("id"), bit.alias("bits")).filter("id is not null")
    newest, rows, path = scratch.write(begin.groupBy("id").agg(F.bit_or("bits").alias("bits")))
    levels = [path]
    while rows:
        seen = scratch.read(newest, *levels).groupBy("id").agg(F.bit_or("bits").alias("had"))
        sent = steps.join(newest, steps["near"] == newest["id"]).groupBy(F.col("far").alias("id")).agg(F.bit_or("bits").alias("bits"))
        fresh = F.col("bits").bitwiseAND(F.bitwise_not(F.coalesce("had", F.lit(0).cast("bigint"))))
        newest, rows, path = scratch.write(sent.join(seen, "id", "left").select("id", fresh.alias("bits")).filter("bits <> 0"))
        levels.append(path)
    scratch.keep_only(levels)
    reached = scratch.read(newest, *levels)
    named = F.filter(F.sequence(F.lit(0), F.lit(MOST_SELECTIONS - 1)), lambda k: F.getbit("bits", k) == 1)
    return reached.select(F.explode(named).alias("selection"), "id")


def select_nodes(nodes: DataFrame, method: str, value: str) -> DataFrame:
    """Ids of the nodes a selector method matches; an unknown method compares the id.

    Columns of `nodes`: id, path, materialized, tags (an array).
    """
    matches = {
        "tag": F.array_contains("tags", F.lit(value)),
        "path": F.contains(F.col("path"), F.lit(value)),
        "config.materialized": F.col("materialized") == value,
    }.get(method, F.col("id") == value)
    return nodes.filter(matches).select("id")


def set_union(*parts: DataFrame) -> DataFrame:
    """Ids in any part: one distinct over all of them."""
    return reduce(DataFrame.unionByName, parts).distinct()


def set_intersect(*parts: DataFrame) -> DataFrame:
    """Ids in every part, by one grouping of all parts: a bit per part, or-ed map-side."""
    marked = [part.toDF("id").withColumn("\0bit", F.lit(1 << i)) for i, part in enumerate(parts)]
    seen = reduce(DataFrame.unionByName, marked).groupBy("id").agg(F.bit_or("\0bit").alias("\0bits"))
    return seen.filter(F.col("\0bits") == (1 << len(parts)) - 1).select("id")


def dangling_refs(edges: DataFrame, nodes: DataFrame, id_col: str = "id") -> DataFrame:
    """Distinct edges whose upstream node does not exist.

    References are made distinct first: a target that very many edges name is looked up once.
    """
    known = nodes.select(F.col(id_col).alias("upstream"))
    wanted = edges.select("upstream").filter("upstream is not null").distinct()
    missing = own_shuffle(wanted.join(known, "upstream", "left_anti"), "upstream")
    return edges.join(missing, "upstream", "left_semi").select("upstream", "downstream").distinct()
