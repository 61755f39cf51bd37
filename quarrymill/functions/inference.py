"""Column types from the data itself: one distributed pass, one small row back."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.columns import exact
from quarrymill.functions.types import (
    apply_types,
    cast_column,
    number_digits,
    numeric_type,
    text_schema,
)

# The text shape of each CSV class. `\z` is the very end of the text.
CSV_SHAPES = {
    "boolean": r"(?i)^(true|false)\z",
    "date": r"^\d{4}-\d{2}-\d{2}\z",
    "timestamptz": r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?\z",
    "bigint": r"^-?\d+\z",
    "numeric": r"^-?(\d+\.\d*|\.\d+)\z",
}

# Each class is one bit, so that a column's classes are a single `bit_or`.
_CSV_BIT = {name: 1 << i for i, name in enumerate([*CSV_SHAPES, "text"])}
_CSV_TYPE_OF_BITS = {
    **{bit: name for name, bit in _CSV_BIT.items()},
    _CSV_BIT["bigint"] | _CSV_BIT["numeric"]: "numeric",
    _CSV_BIT["date"] | _CSV_BIT["timestamptz"]: "timestamptz",
}

# JSON classes from weakest to strongest; a column takes its strongest.
JSON_RANKS = ("unknown", "boolean", "bigint", "double precision", "text", "jsonb")


def _fits_bigint(digits: Column) -> Column:
    """Whether a whole number's text is in the bigint range, by length and then by digits.

    A failing cast would raise and catch an exception for every number that is too large.
    """
    bare = F.ltrim(digits, F.lit("-0"))
    length = F.octet_length(bare)
    largest = F.when(F.substring(digits, 1, 1) == "-", "9223372036854775808").otherwise("9223372036854775807")
    return F.when(length == 19, bare <= largest).otherwise(length < 19)


def _csv_bit(text: Column) -> Column:
    """The class of one value, with few regular expressions per value.

    The first character tells numbers and dates from words; the fifth tells dates from numbers.
    """
    first, fifth = F.substring(text, 1, 1), F.substring(text, 5, 1)
    numeral = first.between("0", "9") | first.isin("-", ".")
    return (
        F.when(text.isNull(), F.lit(None).cast("int"))
        .when(
            numeral,
            F.when(
                text.rlike(CSV_SHAPES["bigint"]),
                F.when(_fits_bigint(text), _CSV_BIT["bigint"]).otherwise(_CSV_BIT["numeric"]),
            )
            .when((fifth != "-") & text.rlike(CSV_SHAPES["numeric"]), _CSV_BIT["numeric"])
            .when((fifth == "-") & text.rlike(CSV_SHAPES["date"]), _CSV_BIT["date"])
            .when((fifth == "-") & text.rlike(CSV_SHAPES["timestamptz"]), _CSV_BIT["timestamptz"])
            .otherwise(_CSV_BIT["text"]),
        )
        .when(first.isin("t", "T", "f", "F") & text.rlike(CSV_SHAPES["boolean"]), _CSV_BIT["boolean"])
        .otherwise(_CSV_BIT["text"])
    )


def infer_csv_types(df: DataFrame) -> dict[str, str]:
    """The warehouse type of every text column, numeric ones sized.

    One pass: values are unpivoted, classed, and combined map-side to one row per column, with the
    classes as a bit set and the digits its numbers need. The generated code is the same for ten
    columns and for a thousand.
    """
    if not df.columns:
        return {}
    named = df.select(*[exact(name).alias(str(i)) for i, name in enumerate(df.columns)])
    values = named.unpivot([], named.columns, "column", "value").filter("value is not null")
    classed = values.select("column", "value", _csv_bit(F.col("value")).alias("class"))
    numeric = F.when(F.col("class") == _CSV_BIT["numeric"], F.col("value"))
    whole, fraction = number_digits(numeric)
    seen = classed.groupBy("column").agg(
        F.bit_or("class").alias("bits"), F.max(whole).alias("whole"), F.max(fraction).alias("fraction")
    )
    found = {df.columns[int(row["column"])]: row for row in seen.collect()}
    types = {}
    for name in df.columns:
        row = found.get(name)
        kind = _CSV_TYPE_OF_BITS.get(row["bits"], "text") if row else "text"
        types[name] = numeric_type(name, row["whole"], row["fraction"]) if kind == "numeric" else kind
    return types


def type_csv(df: DataFrame) -> DataFrame:
    """Infer, then cast: shape decides the type, so `2024-99-99` fails here as a bad date."""
    return apply_types(df, infer_csv_types(df))


def _json_rank(value: Column) -> Column:
    """Rank of one JSON value. Integer-valued numbers are integers however they are written."""
    shape = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    integral = number % 1 == 0
    return (
        F.when(shape == "VOID", 0)
        .when(shape == "BOOLEAN", 1)
        .when(shape.rlike(r"^(OBJECT|ARRAY)"), 5)
        .when(shape == "STRING", 4)
        .when(shape == "BIGINT", 2)
        .otherwise(F.when(integral, 2).otherwise(3))
    )


def json_type_table(df: DataFrame, json_col: str) -> DataFrame:
    """`(key, type)` over all rows of a column of JSON objects.

    Every object is parsed once and exploded into its keys; the maximum rank per key is combined
    map-side, so the shuffle carries one row per key and task.
    """
    keys = df.select(F.parse_json(F.col(json_col)).alias("doc")).lateralJoin(
        df.sparkSession.tvf.variant_explode(F.col("doc").outer())
    )
    rank = F.max(_json_rank(F.col("value"))).alias("rank")
    settled = F.when(F.col("rank") == 0, "text")
    for i, name in enumerate(JSON_RANKS[1:], start=1):
        settled = settled.when(F.col("rank") == i, name)
    return (
        keys.filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(rank)
        .select("key", settled.alias("type"))
    )


def infer_json_types(df: DataFrame, json_col: str, keep: Collection[str] | None = None) -> dict[str, str]:
    """The same as a dict, to make columns of.

    Objects keyed by data have as many keys as rows; name those that are columns in `keep`.
    """
    found = json_type_table(df, json_col)
    if keep is not None:
        found = found.filter(F.col("key").isin(*keep))
    return {row["key"]: row["type"] for row in found.collect()}


def type_json(df: DataFrame, json_col: str, types: dict[str, str]) -> DataFrame:
    """Replace a column of JSON objects by one typed column per key.

    One parse per row: all keys are read as text, in which objects and arrays are their JSON.
    """
    others = [exact(name) for name in df.columns if name != json_col]
    parsed = F.from_json(F.col(json_col), text_schema(sorted(types)), {"mode": "FAILFAST"})
    flat = df.select(*others, parsed.alias("\0doc"))
    return flat.select(
        *others, *[_typed(F.col("\0doc")[name], kind).alias(name) for name, kind in sorted(types.items())]
    )


def _typed(text: Column, kind: str) -> Column:
    if kind == "bigint":
        # `1.0` and `1e3` are integers in JSON but not in a cast from text; decimals keep all digits of them.
        plain = text.rlike(CSV_SHAPES["bigint"])
        return F.when(plain, text.cast("bigint")).otherwise(text.cast("decimal(38,10)").cast("bigint"))
    return cast_column(text, T.StringType(), kind)


def stringify_nested(df: DataFrame, json_col: str, types: dict[str, str]) -> DataFrame:
    """Only the `jsonb` keys of a JSON column: nested values as JSON text, scalars as they are."""
    nested = {name: kind for name, kind in types.items() if kind == "jsonb"}
    return type_json(df, json_col, nested)

