"""Joins whose other side may hold one key very often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def own_shuffle(df: DataFrame, key: str) -> DataFrame:
    """Make a join on `key` shuffle this side again, although it is already grouped by `key`.

    Spark splits a skewed partition at run time only where both sides of the join come straight
    from a shuffle. A side that was aggregated by the join key brings its partitioning along, and
    the hot partition of the other side would stay one task. `greatest(key, key)` is the key, but
    the planner does not know that it is. Use this on sides with one row per key, where the extra
    shuffle is small.
    """
    return df.withColumn(key, F.greatest(F.col(key), F.col(key)))
