"""Pages at any depth."""

import random
import re

import pytest
from pyspark.sql import functions as F

from quarrymill.operators.paging import keyset_page, write_pages


def test_every_page_is_a_slice_and_reads_few_ranges(spark, tmp_path):
    rng = random.Random(2)
    values = [(rng.randint(0, 30) if rng.random() < 0.9 else None, i) for i in range(500)]
    path = str(tmp_path / "pages")
    write_pages(spark.createDataFrame(values, "at int, id long").repartition(5), path, ["at", "id"], 8)
    expected = sorted(values, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for offset in (0, 1, 99, 250, 498, 499, 500, 900):
        page = keyset_page(spark, path, ["at", "id"], offset, 40)
        assert [tuple(r) for r in page.collect()] == expected[offset : offset + 40]
    middle = keyset_page(spark, path, ["at", "id"], 250, 10)
    plan = middle._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ymill_range#\d+ (= \d+|IN \(\d+,\d+\))\)?\], PushedFilters: \[\]", plan), plan
    held = spark.read.parquet(f"{path}/counts").filter((F.col("before") < 260) & (F.col("before") + F.col("rows") > 250))
    assert held.count() <= 2 and spark.read.parquet(f"{path}/counts").count() == 8


@pytest.mark.parametrize("rows", [0, 1])
def test_hardly_any_rows(spark, tmp_path, rows):
    path = str(tmp_path / "pages")
    write_pages(spark.range(10).limit(rows), path, ["id"], 4)
    assert keyset_page(spark, path, ["id"], 0, 5).columns == ["id"]
    assert keyset_page(spark, path, ["id"], 0, 5).count() == rows
    assert keyset_page(spark, path, ["id"], 1, 5).count() == 0
