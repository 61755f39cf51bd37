"""Connected components of a table of links, by hooking to the smallest neighbour and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import staged


def _roots(parents: DataFrame) -> DataFrame:
    """node, label: follow parents to the end, halving the way in each round."""
    while True:
        above = parents.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = parents.join(above, "label").select("node", F.col("next").alias("label"), "label")
        jumped = staged(jumped.toDF("node", "next", "label"), "jumped")
        parents = jumped.select("node", F.col("next").alias("label"))
        if jumped.filter("next <> label").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node that links lead to, for each node of `links` (columns a and b).

    Each round hooks every component to its smallest neighbour and shortens the ways to the roots, so that a chain of
    any length is one round of logarithmically many joins. Nothing is collected.
    """
    links = staged(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while True:
        both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
        parents = both.groupBy("node").agg(F.min("other").alias("label"))
        parents = staged(parents.select("node", F.least("node", "label").alias("label")), "parents")
        roots = _roots(parents)
        if labels is None:
            labels = roots
        else:
            moved = roots.select(F.col("node").alias("label"), F.col("label").alias("moved"))
            labels = labels.join(moved, "label", "left").select("node", F.coalesce("moved", "label").alias("label"))
            labels = staged(labels, "labels")
        left = roots.select(F.col("node").alias("a"), F.col("label").alias("x"))
        right = roots.select(F.col("node").alias("b"), F.col("label").alias("y"))
        links = links.join(left, "a").join(right, "b").filter("x <> y")
        links = staged(links.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if links.isEmpty():
            return labels
