"""Pages of a sorted table at any depth: ranges of rows with running counts say where the k-th row is."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.columns import exact

_RANGE = "_quarrymill_range"


def write_pages(df: DataFrame, path: str, order_by: Sequence[str], ranges: int) -> None:
    """Write the rows at `path` in `ranges` of about equally many, in the order of these columns, and how many rows precede each.

    The columns must order all rows, so end them with a unique one. Rows that agree in all of them share a range.
    """
    keys = [exact(name) for name in order_by]
    dealt = df.repartitionByRange(ranges, *keys).withColumn(_RANGE, F.spark_partition_id())
    dealt.sortWithinPartitions(*keys).write.partitionBy(_RANGE).parquet(f"{path}/rows")
    schema = T.StructType([*df.schema.fields, T.StructField(_RANGE, T.IntegerType())])
    df.sparkSession.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(f"{path}/schema")
    counted = _rows(df.sparkSession, path).groupBy(_RANGE).count().orderBy(_RANGE).collect()
    before, listed = 0, []
    for row in counted:
        listed.append((row[_RANGE], before, row["count"]))
        before += row["count"]
    counts = df.sparkSession.createDataFrame(listed, f"{_RANGE} int, before bigint, rows bigint")
    counts.coalesce(1).write.parquet(f"{path}/counts")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/schema").first()[0]))
    return spark.read.schema(schema).parquet(f"{path}/rows")


def keyset_page(spark: SparkSession, path: str, order_by: Sequence[str], offset: int, size: int) -> DataFrame:
    """`size` rows from the one at `offset` on, in order. Only the ranges that hold them are read: mostly one, however deep the page is.

    One short row per range comes to the driver.
    """
    counts = spark.read.parquet(f"{path}/counts")
    held = counts.filter((F.col("before") < offset + size) & (F.col("before") + F.col("rows") > offset)).orderBy("before").collect()
    rows = _rows(spark, path).filter(F.col(_RANGE).isin([row[_RANGE] for row in held])).drop(_RANGE)
    skipped = offset - held[0]["before"] if held else 0
    return rows.orderBy(*map(exact, order_by)).offset(skipped).limit(size)
