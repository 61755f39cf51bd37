"""Warehouse type names, the source types that map to them, and casts of whole tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.columns import exact

# Warehouse type name -> Spark type.
# A bare `numeric` has no scale of its own: it has one fixed size, below.
WAREHOUSE_TYPES = {
    "smallint": "smallint",
    "integer": "int",
    "bigint": "bigint",
    "real": "float",
    "double precision": "double",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp_ntz",
    "timestamptz": "timestamp",
    "text": "string",
    "uuid": "string",
    "json": "string",
    "jsonb": "string",
}

# Postgres catalog type -> warehouse type, where the names differ.
# Every type that is neither here nor in WAREHOUSE_TYPES lands as text.
POSTGRES_RENAMES = {
    "timestamp without time zone": "timestamp",
    "timestamp with time zone": "timestamptz",
    "character varying": "text",
    "character": "text",
}

# ClickHouse type -> warehouse type, parameters left off.
CLICKHOUSE_TYPES = {
    "Int8": "integer",
    "Int16": "integer",
    "Int32": "integer",
    "Int64": "bigint",
    "UInt8": "integer",
    "UInt16": "integer",
    "UInt32": "bigint",
    "UInt64": "bigint",
    "Float32": "real",
    "Float64": "double precision",
    "Decimal": "numeric",
    "Decimal32": "numeric",
    "Decimal64": "numeric",
    "Decimal128": "numeric",
    "Decimal256": "numeric",
    "Bool": "boolean",
    "Boolean": "boolean",
    "Date": "date",
    "Date32": "date",
    "DateTime": "timestamptz",
    "DateTime64": "timestamptz",
    "UUID": "uuid",
    "String": "text",
    "FixedString": "text",
    "Enum": "text",
    "Enum8": "text",
    "Enum16": "text",
}
# Types that take no parameters; with a bracket they are some other type, which lands as text.
_CLICKHOUSE_BARE = {"Int8", "Int16", "Int32", "Int64", "UInt8", "UInt16", "UInt32", "UInt64",
                    "Float32", "Float64", "Bool", "Boolean", "Date", "Date32", "UUID", "String"}
# What may stand around a type.
_CLICKHOUSE_WRAPPERS = ("Nullable", "LowCardinality", "SimpleAggregateFunction")

_MAX_PRECISION = 38
_BIGINT_DIGITS = 19
# The size of a `numeric` that declares none: the same for every batch of a table. A number that does not fit,
# with more than 20 digits before the point or 18 after it, fails the load and is never rounded.
BARE_NUMERIC = "numeric(38,18)"
# Digits of the ClickHouse decimals that declare a scale only; beyond 38 Spark has no decimal.
_CLICKHOUSE_DIGITS = {"Decimal32": 9, "Decimal64": 18, "Decimal128": 38, "Decimal256": 38}


def text_schema(names: Iterable[str]) -> T.StructType:
    """Every column as text, to be cast later."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def spark_type(warehouse_type: str) -> str:
    """The Spark type of a warehouse type. `numeric(p,s)` is a decimal of that size, `numeric` one of a fixed size."""
    name = warehouse_type.strip().lower()
    if name == "numeric":
        name = BARE_NUMERIC
    if name in WAREHOUSE_TYPES:
        return WAREHOUSE_TYPES[name]
    sized = re.fullmatch(r"numeric\((\d+),\s*(\d+)\)", name)
    if sized:
        return f"decimal({sized[1]},{sized[2]})"
    raise ValueError(f"no Spark type for warehouse type {warehouse_type!r}")


def postgres_type(data_type: str) -> str:
    name = data_type.lower()
    if name == "numeric" or name in WAREHOUSE_TYPES:
        return name
    return POSTGRES_RENAMES.get(name, "text")


def clickhouse_type(declared: str, wide_uint64: bool = False) -> str:
    """`wide_uint64` keeps UInt64 above the bigint range as numeric(20,0)."""
    shape = declared.strip()
    while (wrapped := re.fullmatch(r"(\w+)\((.*)\)", shape, re.S)) and wrapped[1] in _CLICKHOUSE_WRAPPERS:
        shape = wrapped[2].strip()
    if wide_uint64 and shape == "UInt64":
        return "numeric(20,0)"
    name, bracket, inside = shape.partition("(")
    if bracket and name in _CLICKHOUSE_BARE:
        return "text"
    sizes = [int(x) for x in re.findall(r"\d+", inside)]
    if name in _CLICKHOUSE_DIGITS and len(sizes) == 1:
        sizes.insert(0, _CLICKHOUSE_DIGITS[name])
    if CLICKHOUSE_TYPES.get(name) == "numeric" and sizes:
        precision, scale = min(sizes[0], _MAX_PRECISION), sizes[1] if len(sizes) > 1 else 0
        return f"numeric({precision},{scale})"
    return CLICKHOUSE_TYPES.get(name, "text")


def number_digits(text: Column) -> tuple[Column, Column]:
    """How many digits a number's text needs before and after the point."""
    point = F.instr(text, ".")
    before = F.when(point > 0, F.substring(text, F.lit(1), point - 1)).otherwise(text)
    after = F.when(point > 0, F.octet_length(text) - point).otherwise(0)
    whole = F.octet_length(F.ltrim(before, F.lit("+-0")))

    exponent = F.regexp_extract(text, r"[eE]([+-]?\d+)$", 1).cast("int")
    mantissa = F.regexp_extract(text, r"^(.*?)[eE]", 1)
    mantissa_point = F.instr(mantissa, ".")
    mantissa_after = F.when(mantissa_point > 0, F.octet_length(mantissa) - mantissa_point).otherwise(0)
    mantissa_whole = F.octet_length(F.ltrim(F.substring_index(mantissa, ".", 1), F.lit("+-0")))
    scientific = (F.instr(text, "E") > 0) | (F.instr(text, "e") > 0)
    return (
        F.when(scientific, F.greatest(mantissa_whole + exponent, F.lit(0))).otherwise(whole),
        F.when(scientific, F.greatest(mantissa_after - exponent, F.lit(0))).otherwise(after),
    )


def numeric_type(name: str, whole: int | None, fraction: int | None) -> str:
    """A decimal for numbers with that many digits before and after the point; 38 is the limit.

    It has room for whole numbers as large as a bigint, so that later batches fit, and no more
    than that, so that columns of different scale can be combined without losing digits.
    """
    whole, fraction = whole or 0, fraction or 0
    if whole + fraction > _MAX_PRECISION:
        raise ValueError(
            f"column {name!r} needs {whole + fraction} digits; a decimal holds {_MAX_PRECISION}"
        )
    return f"numeric({min(max(whole, _BIGINT_DIGITS) + fraction, _MAX_PRECISION)},{fraction})"


def exact_cast(value: Column, from_type: T.DataType, to_type: T.DataType) -> Column:
    """An ANSI cast that also refuses to round: a number with more decimals than fit is an error."""
    cast = value.cast(to_type)
    if not isinstance(to_type, T.DecimalType) or isinstance(from_type, T.IntegralType):
        return cast
    if isinstance(from_type, T.DecimalType):
        if from_type.scale <= to_type.scale:
            return cast
        fits = cast == value
    else:
        fits = number_digits(value.cast("string"))[1] <= to_type.scale
    refusal = F.raise_error(
        F.concat(F.lit(f"cannot keep all decimals as {to_type.simpleString()}: "), value.cast("string"))
    )
    return F.when(value.isNull() | fits, cast).otherwise(refusal.cast(to_type))


def _with_seconds(text: Column) -> Column:
    """`2024-01-01T12:00Z` as `2024-01-01T12:00:00Z`: Spark wants seconds before a zone."""
    zone_follows = F.substring(text, 17, 1).isin("Z", "+", "-")
    spelled = F.concat(F.substring(text, 1, 16), F.lit(":00"), F.substring(text, 17, 6))
    return F.when(zone_follows, spelled).otherwise(text)


def _iso(ts: Column) -> Column:
    """A time as ISO text in UTC, to the millisecond, or to the microsecond where that says more."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    finer = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return F.when(F.unix_micros(ts) % 1000 == 0, whole).otherwise(finer)


def _castable(value: Column, from_type: T.DataType, warehouse_type: str) -> Column:
    if isinstance(from_type, T.StringType):
        return _with_seconds(value) if warehouse_type == "timestamptz" else value
    if spark_type(warehouse_type) == "string":
        if isinstance(from_type, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(value)
        if isinstance(from_type, (T.TimestampType, T.TimestampNTZType)):
            return _iso(value.cast("timestamp"))
    return value


def cast_column(value: Column, from_type: T.DataType, warehouse_type: str) -> Column:
    """An ANSI cast: a value the type cannot hold, all its decimals included, fails the job."""
    given, to_type = _castable(value, from_type, warehouse_type), T.DataType.fromDDL(spark_type(warehouse_type))
    cast = exact_cast(given, from_type, to_type) if isinstance(to_type, T.DecimalType) else given.cast(to_type)
    return F.lower(cast) if warehouse_type == "uuid" else cast


def try_cast_column(value: Column, from_type: T.DataType, warehouse_type: str) -> Column:
    """The same cast with NULL for a value the type cannot hold."""
    cast = _castable(value, from_type, warehouse_type).try_cast(spark_type(warehouse_type))
    return F.lower(cast) if warehouse_type == "uuid" else cast


def settle_numeric(df: DataFrame, types: Mapping[str, str]) -> dict[str, str]:
    """Give every bare `numeric` its size: that of a column which is a decimal already, else the fixed one.

    Nothing is measured, as the next batch of the same table may hold other numbers.
    """
    settled = dict(types)
    for name, kind in types.items():
        if kind == "numeric":
            field = df.schema[name].dataType
            decimal = isinstance(field, T.DecimalType)
            settled[name] = f"numeric({field.precision},{field.scale})" if decimal else BARE_NUMERIC
    return settled


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast every column to its warehouse type; columns without one become text."""
    full = {name: types.get(name, "text") for name in df.columns}
    settled = settle_numeric(df, full)
    return df.select(
        *[
            cast_column(exact(name), df.schema[name].dataType, settled[name]).alias(name)
            for name in df.columns
        ]
    )


def apply_pg_types(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Types as a Postgres catalog declares them (`information_schema` data types)."""
    return apply_types(df, {name: postgres_type(kind) for name, kind in declared.items()})


def apply_clickhouse_types(
    df: DataFrame, declared: Mapping[str, str], wide_uint64: bool = False
) -> DataFrame:
    """Types as a ClickHouse DESCRIBE gives them."""
    return apply_types(
        df, {name: clickhouse_type(kind, wide_uint64) for name, kind in declared.items()}
    )


def coerce_literals(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Strict load of text into typed columns: NULL stays NULL, a bad value fails the job."""
    return apply_types(df, types)


def coerce_or_reject(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """The same load with bad values set to NULL and their column names listed in `rejected`."""
    settled = {name: types.get(name, "text") for name in df.columns}
    for name, kind in settled.items():
        if kind == "numeric":
            raise ValueError(f"give {name!r} a sized type, numeric(p,s), to load with rejects")
    cast = {
        name: try_cast_column(exact(name), df.schema[name].dataType, kind)
        for name, kind in settled.items()
    }
    bad = [
        F.when(exact(name).isNotNull() & value.isNull(), F.lit(name))
        for name, value in cast.items()
    ]
    return df.select(
        *[value.alias(name) for name, value in cast.items()],
        F.array_compact(F.array(*bad)).alias("rejected"),
    )
