"""Scalar expressions the models share. All are built-in functions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LEADING_DATE = r"^\d{4}-"


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(id_col: Column | str, source: str) -> Column:
    """md5 of the id's text followed by the source name; NULL for a NULL id."""
    return F.md5(F.concat(_as_column(id_col).cast("string"), F.lit(source)))


def coalesce_zero(value: Column | str) -> Column:
    return F.coalesce(_as_column(value), F.lit(0))


def epoch_to_ts(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_as_column(seconds))


def guarded_epoch(seconds: Column | str) -> Column:
    """Epoch seconds held as any type, an all-NULL text column included."""
    value = _as_column(seconds)
    return F.when(value.isNotNull(), F.timestamp_seconds(value.cast("bigint")))


# Further spellings of a time, in UTC: of mail and HTTP headers, and dates with slashes.
_SPELLINGS = [
    (r"^[A-Za-z]{3}, \d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} (GMT|UTC)\z", "dd MMM yyyy HH:mm:ss", 6, 20),
    (r"^\d{4}/\d{2}/\d{2}\z", "yyyy/MM/dd", 1, 10),
    (r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}\z", "yyyy/MM/dd HH:mm:ss", 1, 19),
    (r"^\d{2}/\d{2}/\d{4}\z", "MM/dd/yyyy", 1, 10),
]


def epoch_or_iso_seconds(text: Column | str) -> Column:
    """Unix seconds from digits, from an ISO date or timestamp, or from a header's or slashed date; else NULL."""
    value = _as_column(text)
    parsed = F.floor(F.unix_micros(value.try_cast("timestamp")) / F.lit(1_000_000))
    seconds = F.when(value.rlike(r"^\d+\z"), value.try_cast("bigint")).when(
        value.rlike(_LEADING_DATE), parsed.cast("bigint")
    )
    for shape, pattern, start, length in _SPELLINGS:
        spelled = F.try_to_timestamp(F.substring(value, start, length), F.lit(pattern))
        seconds = seconds.when(value.rlike(shape), F.unix_seconds(spelled.cast("timestamp")))
    return seconds


def null_of(spark_type: str) -> Column:
    return F.lit(None).cast(spark_type)


def pg_cast(value: Column | str, warehouse_type: str) -> Column:
    """`value::type` for the type names of `functions.types`."""
    from quarrymill.functions.types import spark_type

    return _as_column(value).cast(spark_type(warehouse_type))
