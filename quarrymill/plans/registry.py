"""The named queries and, where SQL can say the same, the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quarrymill.functions.columns import exact
from quarrymill.session import pin

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECK_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(pin(spark), sf_dir.rstrip("/")))

        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql.strip()
        return run

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Result types that two engines print alike: exact decimals as doubles, UTC wall-clock times."""

    def plain(field: T.StructField):
        column = exact(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column

    return df.select(*[plain(field) for field in df.schema.fields])
