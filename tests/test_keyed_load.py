"""Streams of changes by keyed state."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from quarrymill.session import shared_dir
from quarrymill.streaming.keyed_load import compact_newest, log_of, newest_in_batches, stream_newest

SCHEMA = "id long, seq int, name string"


@pytest.fixture
def land(spark, store, frame):
    folder = f"{shared_dir(spark)}/keyed_{uuid.uuid4().hex}"

    def run(*rows):
        frame(SCHEMA, *rows).coalesce(2).write.mode("append").parquet(folder)
        arriving = spark.readStream.schema(SCHEMA).parquet(folder)
        stream_newest(store, "t", arriving, f"{folder}_checkpoint", "id", "seq").awaitTermination()

    return run


def test_late_and_repeated_rows_change_nothing(store, land, rows):
    land((1, 5, "a"), (1, 7, "b"), (2, None, "null"), (None, 1, "x"), (3, 1, "c"))
    assert sorted(rows(store.table("t")), key=repr) == sorted([(1, 7, "b"), (2, None, "null"), (None, 1, "x"), (3, 1, "c")], key=repr)
    land((1, 6, "late"), (1, 7, "again"), (2, None, "again"), (None, 1, "x"), (3, 2, "newer"))
    assert sorted(rows(store.table("t")), key=repr) == sorted(
        [(1, 7, "b"), (2, None, "null"), (None, 1, "x"), (None, 1, "x"), (3, 2, "newer")], key=repr
    )
    # Rows that did not win were not written.
    assert store.table(log_of("t")).filter("id = 1").count() == 1
    land((2, 0, "known"), (2**60 + 1, 1, "large"))
    compact_newest(store, "t")
    assert store.table(log_of("t")).count() == store.table("t").count() == 6
    land((2, 0, "repeat"), (3, 1, "late"))
    assert rows(store.table("t").filter("id in (2, 3)")) == [(2, 0, "known"), (3, 2, "newer")]
    assert store.table("t").filter(F.col("id") == 2**60 + 1).count() == 1


def test_hot_keys_are_thinned_before_the_shuffle(spark):
    hot = spark.range(0, 20_000, 1, 2).selectExpr("if(id % 3 = 0, 7, id) AS id", "cast(id AS int) AS seq", "'x' AS name")
    thin = newest_in_batches(hot, "id", "seq")
    assert thin.filter("id = 7").count() <= 4 and thin.agg(F.max("seq")).first()[0] == 19_999
    assert thin.filter("id <> 7").count() == hot.filter("id <> 7").count()


def test_small_arrow_batches_are_thinned_together(spark):
    hot = spark.range(0, 20_000, 1, 2).selectExpr("if(id % 3 = 0, 7, id) AS id", "cast(id AS int) AS seq", "'x' AS name")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        thin = newest_in_batches(hot, "id", "seq")
        assert thin.filter("id = 7").count() <= 4
        assert thin.filter("id <> 7").count() == hot.filter("id <> 7").count()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
