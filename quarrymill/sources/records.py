"""Sources whose column types are declared elsewhere: JSON lines, JDBC tables, catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.types import apply_clickhouse_types, text_schema


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_jsonl(
    spark: SparkSession, path: str, declared: Mapping[str, str], wide_uint64: bool = False
) -> DataFrame:
    """One JSON object per line, columns and types as a ClickHouse DESCRIBE declares them.

    Values are read as text first, because 64-bit integers arrive as strings. Blank lines are
    skipped; a line that is not JSON fails the job. Lines split, so one file is many tasks.
    """
    text = spark.read.schema(text_schema(declared)).option("mode", "FAILFAST").json(path)
    return apply_clickhouse_types(text, declared, wide_uint64)


def table_identifier(stream: str, identifier: str | None = None, schema: str | None = None) -> str:
    """`schema.table` of a stream: an explicit identifier or schema wins, `public` is assumed."""
    head, dot, tail = (identifier or stream).partition(".")
    table = tail.split(".")[0] if dot else head
    return f"{schema or (head if dot else 'public')}.{table}"


def jdbc_reader(
    spark: SparkSession, url: str, properties: Mapping[str, str] | None = None, fetch_size: int = 10_000
) -> DataFrameReader:
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    reader = reader.option("preferTimestampNTZ", True)
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader


def partition_options(
    column: str, lowest: object, highest: object, num_partitions: int
) -> dict[str, str]:
    """Options that make Spark read a table in ranges of one column, one query per range."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lowest),
        "upperBound": str(highest),
        "numPartitions": str(num_partitions),
    }


# Ranges that one count query measures; each is a column of it.
_MEASURED = 64


def equi_depth_ranges(
    count: Callable[[list[tuple[int, int]]], list[int]], low: int, high: int, parts: int
) -> list[tuple[int, int]]:
    """At most about `parts` ranges [a, b) that cover `low` to `high` and hold about equally many rows each.

    `count` tells how many rows each of some ranges holds. Ranges that hold too many are cut into equal widths and counted again, however
    uneven the values are; only a value that repeats too often stays a range of its own. Neighbours that hold little are joined.
    """
    pieces = [(low, high + 1, count([(low, high + 1)])[0])]
    most = max(1, -(-pieces[0][2] // parts))
    while heavy := [piece for piece in pieces if piece[2] > most and piece[1] - piece[0] > 1]:
        bins = max(2, _MEASURED // len(heavy))
        cuts = []
        for a, b, _ in heavy:
            number = min(bins, b - a)
            edges = [a + (b - a) * k // number for k in range(number + 1)]
            cuts += zip(edges, edges[1:])
        counts = [n for k in range(0, len(cuts), _MEASURED) for n in count(cuts[k : k + _MEASURED])]
        pieces = sorted([*(piece for piece in pieces if piece not in heavy), *((a, b, n) for (a, b), n in zip(cuts, counts))])
    ranges: list[list[int]] = []
    held = 0
    for a, b, n in pieces:
        if ranges and held + n <= most:
            ranges[-1][1], held = b, held + n
        else:
            ranges.append([a, b])
            held = n
    return [(a, b) for a, b in ranges]


def _even_predicates(reader: DataFrameReader, source: str, column: str, low: object, high: object, parts: int) -> list[str]:
    """Conditions that select every row once, about equally many each. Rows beyond the bounds go to the outer ones, NULL to the first."""
    if not all(isinstance(end, (int, Decimal)) and end == int(end) for end in (low, high)):
        raise ValueError(f"{column}: even ranges need a column of whole numbers")

    def count(ranges: list[tuple[int, int]]) -> list[int]:
        counts = ", ".join(f"count(case when {column} >= {a} and {column} < {b} then 1 end) n{k}" for k, (a, b) in enumerate(ranges))
        where = f"{column} >= {ranges[0][0]} and {column} < {ranges[-1][1]}"
        return [int(n) for n in reader.option("query", f"select {counts} from {source} where {where}").load().first()]

    ranges = equi_depth_ranges(count, int(low), int(high), parts)
    if len(ranges) == 1:
        return ["1 = 1"]
    first, last = ranges[0], ranges[-1]
    inner = [f"{column} >= {a} and {column} < {b}" for a, b in ranges[1:-1]]
    return [f"{column} < {first[1]} or {column} is null", *inner, f"{column} >= {last[0]}"]


def scan_jdbc_full(
    spark: SparkSession,
    url: str,
    stream: str,
    partition_column: str | None = None,
    num_partitions: int | None = None,
    identifier: str | None = None,
    schema: str | None = None,
    properties: Mapping[str, str] | None = None,
    predicates: list[str] | None = None,
    past: tuple[str, str] | None = None,
    even: bool = False,
) -> DataFrame:
    """A whole database table, read in parallel ranges of a numeric, date or timestamp column.

    The ranges cover every value and NULL, so no row is skipped or read twice however the column
    repeats. They are equally wide. Where values are so uneven that one of them would hold most rows, ask for `even` ranges of whole
    numbers, which a few count queries find, or give `predicates`
    instead: conditions, one query each, that together select every row once. Filters and columns
    of what follows are pushed into the queries.

    `past`, a column and a SQL literal, is the condition of an incremental load. It is part of the query for
    the bounds, so that the ranges divide what is read and not the whole table, and of every read.
    Reading as one task must be asked for: `num_partitions=1`.
    """
    if not predicates and num_partitions != 1 and (partition_column is None or not num_partitions):
        raise ValueError(f"{stream}: give a partition_column and num_partitions, predicates, or num_partitions=1")
    table = table_identifier(stream, identifier, schema)
    reader = jdbc_reader(spark, url, properties)
    condition = f"{past[0]} > {past[1]}" if past else None
    if predicates:
        each = [f"({p}) and {condition}" for p in predicates] if condition else predicates
        return reader.jdbc(url, table, predicates=each, properties=dict(properties or {}))
    source = f"(select * from {table} where {condition}) past_mark" if condition else table
    if partition_column is None:
        return reader.option("dbtable", source).load()
    where = f" where {condition}" if condition else ""
    bounds = (
        reader.option("query", f"select min({partition_column}) lo, max({partition_column}) hi from {table}{where}")
        .load()
        .first()
    )
    whole = jdbc_reader(spark, url, properties).option("dbtable", source)
    if bounds[0] is None:
        return whole.load()
    if even:
        counted = jdbc_reader(spark, url, properties)
        each = _even_predicates(counted, source, partition_column, bounds[0], bounds[1], num_partitions)
        return jdbc_reader(spark, url, properties).jdbc(url, source, predicates=each, properties=dict(properties or {}))
    return whole.options(**partition_options(partition_column, bounds[0], bounds[1], num_partitions)).load()


def scan_cursor(
    df: DataFrame,
    cursor: str,
    stored: str | None,
    initial: str | None = None,
    overlap: str | int | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """Rows past the high-water mark: the stored one, else the initial one, else all rows.

    The mark is text and is compared as the column's own type, so `9 < 10`; the literal reaches
    the Parquet or JDBC scan. The comparison is strict, which loses rows that arrive later with the
    mark's value; `inclusive` reads rows at the mark again and `overlap` moves it back, by an interval such as `1 hour`
    or, for numbers, by an amount. Merge what either of them reads by key.
    """
    mark = stored if stored is not None else initial
    if mark is None:
        return df
    kind = df.schema[cursor].dataType
    low = F.lit(mark).cast(kind)
    if overlap is None:
        return df.filter(F.col(cursor) >= low if inclusive else F.col(cursor) > low)
    back = F.lit(overlap).cast(kind) if isinstance(kind, T.NumericType) else F.expr(f"interval {overlap}")
    return df.filter(F.col(cursor) >= (low - back).cast(kind))


def scan_past_target(df: DataFrame, cursor: str, target: DataFrame, floor: str = "1970-01-01") -> DataFrame:
    """Rows newer than anything in `target`, or than `floor` where that is empty.

    The bound is a scalar subquery, one row by nature; Spark runs it first and hands its value to
    the scan.
    """
    kind = df.schema[cursor].dataType
    newest = target.agg(F.coalesce(F.max(F.col(cursor)).cast(kind), F.lit(floor).cast(kind)))
    return df.filter(F.col(cursor) > newest.scalar())
