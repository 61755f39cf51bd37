"""Keyed upsert of one DataFrame into another, without a table format underneath.

Only base rows inside the key range of the updates take part in a join; the others pass through in the
scan stage. How the join runs is left to Catalyst and AQE, which know the sizes. Rows with a NULL key never
match anything: they are appended and never shuffled, so any number of them is fine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.columns import exact
from quarrymill.functions.types import exact_cast


class DuplicateKeyError(ValueError):
    """One batch, or a merge target, holds the same key twice."""


@dataclass(frozen=True)
class KeyFacts:
    """What one narrow aggregate over the key column tells about a batch; the range is text."""

    lowest: str | None
    highest: str | None
    duplicated: int


def key_facts(df: DataFrame, key: str, seq: str | None = None) -> KeyFacts:
    """Range of the keys, and how many occur twice (with the same `seq`, if there is one).

    Reads only these columns. Counts are combined map-side, so a hot key costs one row per task.
    """
    keys = [key] if seq is None else [key, seq]
    per_key = df.filter(exact(key).isNotNull()).groupBy(*map(exact, keys)).agg(
        F.count(F.lit(1)).alias("\0n")
    )
    row = per_key.agg(
        F.min(exact(key)).cast("string").alias("lowest"),
        F.max(exact(key)).cast("string").alias("highest"),
        F.count_if(F.col("\0n") > 1).alias("duplicated"),
    ).first()
    return KeyFacts(row["lowest"], row["highest"], row["duplicated"] or 0)


def require_unique(df: DataFrame, key: str, what: str, seq: str | None = None) -> KeyFacts:
    facts = key_facts(df, key, seq)
    if facts.duplicated:
        raise DuplicateKeyError(f"{what}: {facts.duplicated} duplicated value(s) of {key!r}")
    return facts


def latest_per_key(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The row with the greatest `seq` of every key, NULL below all; rows without a key are kept.

    `max_by` is combined map-side, unlike a window, which would sort all rows of a hot key in
    one task.
    """
    rest = [name for name in df.columns if name != key]
    newest = (
        df.filter(exact(key).isNotNull())
        .groupBy(exact(key))
        .agg(F.max_by(F.struct(*map(exact, rest)), F.struct(exact(seq).isNotNull(), exact(seq))).alias("\0row"))
        .select(exact(key), *[F.col("\0row").getField(name).alias(name) for name in rest])
    )
    return newest.unionByName(df.filter(exact(key).isNull()))


def align(df: DataFrame, target: DataFrame, what: str) -> DataFrame:
    """Cast to the target's column types, exactly; a column the target lacks is an error."""
    unknown = [name for name in df.columns if name not in target.columns]
    if unknown:
        raise ValueError(f"{what}: the target has no column {', '.join(map(repr, unknown))}")
    return df.select(
        *[
            exact_cast(exact(name), df.schema[name].dataType, target.schema[name].dataType).alias(name)
            for name in df.columns
        ]
    )


def _within(base: DataFrame, key: str, facts: KeyFacts) -> Column:
    """Whether an update can match a base row; the range reaches the scan and skips row groups."""
    kind = base.schema[key].dataType
    if isinstance(kind, T.BinaryType):
        return exact(key).isNotNull()
    return exact(key).between(F.lit(facts.lowest).cast(kind), F.lit(facts.highest).cast(kind))


def _beyond(base: DataFrame, key: str, facts: KeyFacts) -> Column:
    kind, value = base.schema[key].dataType, exact(key)
    if isinstance(kind, T.BinaryType):
        return value.isNull()
    low, high = F.lit(facts.lowest).cast(kind), F.lit(facts.highest).cast(kind)
    return value.isNull() | (value < low) | (value > high)


def _keys(updates: DataFrame, key: str) -> DataFrame:
    return updates.filter(exact(key).isNotNull()).select(exact(key))


def touched(base: DataFrame, updates: DataFrame, key: str, facts: KeyFacts) -> DataFrame:
    """Base rows whose key the updates have; the key range reaches the scan."""
    if facts.lowest is None:
        return base.limit(0)
    return base.filter(_within(base, key, facts)).join(_keys(updates, key), on=key, how="left_semi")


def newer_than_stored(base: DataFrame, updates: DataFrame, key: str, seq: str, facts: KeyFacts) -> DataFrame:
    """`updates` without rows whose base row has a greater `seq`; NULL is below all."""
    stored = touched(base, updates, key, facts).select(exact(key), exact(seq).alias("\0stored"))
    both = updates.filter(exact(key).isNotNull()).join(stored, on=key, how="left")
    loses = F.col("\0stored").isNotNull() & (exact(seq).isNull() | (exact(seq) < F.col("\0stored")))
    kept = both.filter(~loses).select(*map(exact, updates.columns))
    return kept.unionByName(updates.filter(exact(key).isNull()))


def with_carried(base: DataFrame, updates: DataFrame, key: str, facts: KeyFacts) -> DataFrame:
    """`updates` with the columns it lacks: their value in the base row it replaces, else NULL.

    The base is first cut to the rows that are replaced, within the key range of the updates.
    """
    carried = [name for name in base.columns if name not in updates.columns]
    if not carried:
        return updates
    if facts.lowest is None:
        return updates.unionByName(base.limit(0), allowMissingColumns=True)
    replaced = touched(base, updates, key, facts)
    keyed = updates.filter(exact(key).isNotNull())
    full = keyed.join(replaced.select(exact(key), *map(exact, carried)), on=key, how="left")
    return full.unionByName(updates.filter(exact(key).isNull()), allowMissingColumns=True)


def upsert(base: DataFrame, updates: DataFrame, key: str, facts: KeyFacts) -> DataFrame:
    """`base` with the rows of `updates` inserted or replaced by key, columns in the base's order.

    `updates` holds every key at most once (`facts` comes from that check). Columns it lacks keep
    their value in replaced rows and are NULL in inserted ones.
    """
    columns = [exact(name) for name in base.columns]
    full = with_carried(base, updates, key, facts)
    if facts.lowest is None:
        return base.unionByName(full)
    keys = _keys(updates, key)
    kept = base.filter(_within(base, key, facts)).join(keys, on=key, how="left_anti")
    return base.filter(_beyond(base, key, facts)).select(*columns).unionByName(kept).unionByName(full)
