"""Column tests: `not_null` and `unique`, with failures counted the way a build reports them."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions.columns import exact

KNOWN_TESTS = ("unique", "not_null")
RESULT_SCHEMA = (
    "model string, column string, test string, status string, failures bigint, "
    "duration_ms bigint, error string"
)
Tests = Mapping[str, Sequence[str]]

# Every row is repeated once per column of a grouping, so wide tables are tested in a few scans.
_COLUMNS_AT_ONCE = 16


@dataclass(frozen=True)
class TestedModel:
    """A table and the tests declared on its columns: `{column: [test, ...]}`."""

    name: str
    df: DataFrame
    tests: Tests

    __test__ = False



def check_known(tests: Tests) -> None:
    for column, names in tests.items():
        for name in names:
            if name not in KNOWN_TESTS:
                raise ValueError(f"unknown test {name!r} on column {column!r}")


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, test, failures)`: rows that are NULL, all columns in one aggregate."""
    counts = df.agg(*[F.count_if(exact(name).isNull()).alias(name) for name in columns])
    return counts.select(
        F.explode(
            F.array(*[F.struct(F.lit(name).alias("column"), exact(name).alias("failures")) for name in columns])
        ).alias("r")
    ).select("r.column", F.lit("not_null").alias("test"), "r.failures")


def duplicate_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`(column, test, failures)`: distinct values that occur more than once, NULL apart.

    One scan and one shuffle for all columns: a grouping set per column keeps every value in its
    own type, and counts are combined map-side, so a value that fills a third of the table
    arrives as one row per task.
    """
    keys = [exact(name) for name in columns]
    per_value = df.groupingSets([[key] for key in keys], *keys).agg(
        F.count(F.lit(1)).alias("\0n"), F.grouping_id().alias("\0set")
    )
    # The grouping id has a zero bit, from the left, for the one column that is grouped by.
    all_ones = (1 << len(columns)) - 1
    set_of = {name: all_ones ^ (1 << (len(columns) - 1 - i)) for i, name in enumerate(columns)}
    counts = per_value.agg(
        *[
            F.count_if(
                (F.col("\0set") == set_of[name]) & exact(name).isNotNull() & (F.col("\0n") > 1)
            ).alias(f"\0{i}")
            for i, name in enumerate(columns)
        ]
    )
    return counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(name).alias("column"), F.col(f"\0{i}").alias("failures"))
                    for i, name in enumerate(columns)
                ]
            )
        ).alias("r")
    ).select("r.column", F.lit("unique").alias("test"), "r.failures")


def column_test_counts(df: DataFrame, tests: Tests) -> DataFrame:
    """`(column, test, failures)` of all tests on one table, lazily."""
    check_known(tests)
    wanted = {name: [c for c, names in tests.items() if name in names] for name in KNOWN_TESTS}
    parts = []
    if wanted["not_null"]:
        parts.append(null_counts(df, wanted["not_null"]))
    for first in range(0, len(wanted["unique"]), _COLUMNS_AT_ONCE):
        parts.append(duplicate_counts(df, wanted["unique"][first : first + _COLUMNS_AT_ONCE]))
    if not parts:
        raise ValueError("no tests to run")
    return reduce(DataFrame.unionByName, parts)


def _failures(model: TestedModel, tests: Tests) -> list[tuple]:
    started = time.monotonic()
    rows = column_test_counts(model.df, tests).collect()
    took = round((time.monotonic() - started) * 1000)
    return [
        (model.name, r["column"], r["test"], "fail" if r["failures"] else "pass", r["failures"], took, None)
        for r in rows
    ]


def run_column_tests(spark: SparkSession, models: Sequence[TestedModel]) -> DataFrame:
    """Run the tests of several tables and return one row per test.

    A table's tests run together, save those on columns it does not have. If they fail, they run
    one by one, so that only the tests which cannot run are reported as `error`. What comes to the
    driver is one count per test.
    """
    results: list[tuple] = []
    for model in models:
        check_known(model.tests)
        present = {c: names for c, names in model.tests.items() if c in model.df.columns and names}
        absent = {c: names for c, names in model.tests.items() if c not in model.df.columns}
        results += [
            _error(model, column, name, f"{model.name} has no column {column!r}")
            for column, names in absent.items()
            for name in names
        ]
        if not present:
            continue
        try:
            results += _failures(model, present)
        except PySparkException:
            results += _one_by_one(model, present)
    return spark.createDataFrame(results, RESULT_SCHEMA)


def _error(model: TestedModel, column: str, test: str, message: str) -> tuple:
    return (model.name, column, test, "error", None, 0, message)


def _one_by_one(model: TestedModel, tests: Tests) -> list[tuple]:
    results = []
    for column, names in tests.items():
        for name in names:
            try:
                results += _failures(model, {column: [name]})
            except PySparkException as failed:
                results.append(_error(model, column, name, str(failed).splitlines()[0]))
    return results


def all_passed(results: DataFrame) -> bool:
    return results.filter(F.col("status") != "pass").isEmpty()


def duplicate_ids(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return (
        df.groupBy(*[exact(key) for key in keys])
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter(F.col("copies") > 1)
    )
