"""Totals per group that are kept up with the facts: a load reads its own rows and those it replaces, not the facts before."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.columns import exact
from quarrymill.operators.upsert import align, require_unique
from quarrymill.session import remove_folder, shared_dir
from quarrymill.sinks.store import Batch, LoadResult, Store, last_batch, rows_of_keys, write_merge


@dataclass(frozen=True)
class Totals:
    """What is kept of the facts of each group, in the table `table` with the column `group` and one per measure.

    Measures are SQL expressions over a fact's columns. `sums` are added up and taken away again, exactly: whole numbers and decimals only. `latest` are the greatest values.
    """

    table: str
    group: str
    sums: Mapping[str, str]
    latest: Mapping[str, str] = field(default_factory=dict)


def _widest(kind: T.DataType) -> str:
    if isinstance(kind, T.DecimalType):
        return f"decimal(38,{kind.scale})"
    if isinstance(kind, T.IntegralType):
        return "bigint"
    raise ValueError(f"sums of {kind.simpleString()} cannot be taken back exactly")


def _measured(facts: DataFrame, totals: Totals, sign: int) -> DataFrame:
    """group, the measures of each fact, and whether it comes (1) or goes (-1)."""
    measures = [F.expr(value).alias(name) for name, value in {**totals.sums, **totals.latest}.items()]
    return facts.filter(exact(totals.group).isNotNull()).select(
        exact(totals.group).alias(totals.group), *measures, F.lit(sign).alias("\0sign")
    )


def delta(comes: DataFrame, goes: DataFrame | None, totals: Totals) -> DataFrame:
    """A row per group that changes: what its sums change by, and the latest of what comes and of what goes.

    Partial sums are combined map-side, so a hot group is a row per task.
    """
    both = _measured(comes, totals, 1)
    kinds = {name: _widest(both.schema[name].dataType) for name in totals.sums}
    if goes is not None:
        both = both.unionByName(_measured(goes, totals, -1))
    sign = F.col("\0sign")
    sums = [
        F.coalesce(F.sum(exact(name) * sign), F.lit(0)).cast(kind).alias(name) for name, kind in kinds.items()
    ]
    ends = [
        F.max(F.when(sign == side, exact(name))).alias(f"\0{kind}_{name}")
        for name in totals.latest
        for kind, side in (("comes", 1), ("goes", -1))
    ]
    return both.groupBy(exact(totals.group)).agg(*sums, *ends)


def _settled(
    changes: DataFrame, stored: DataFrame | None, after: DataFrame, totals: Totals, written: Callable[[DataFrame, str], DataFrame]
) -> DataFrame:
    """The new rows of the groups that change. `written` stores a DataFrame under a name, so that it is worked out once.

    A latest value that has gone cannot be undone from totals: only for such groups the facts, as they are `after` the load, are asked.
    """
    group = totals.group
    if stored is None:
        return changes.select(group, *totals.sums, *[F.col(f"\0comes_{name}").alias(name) for name in totals.latest])
    known = stored.select(exact(group), *[exact(name).alias(f"\0was_{name}") for name in (*totals.sums, *totals.latest)])
    joined = changes.join(known, group, "left")
    comes, goes, was = ({name: F.col(f"\0{kind}_{name}") for name in (*totals.sums, *totals.latest)} for kind in ("comes", "goes", "was"))
    sums = [(exact(name) + F.coalesce(was[name], F.lit(0))).cast(changes.schema[name].dataType).alias(name) for name in totals.sums]
    kept = joined.select(
        group, *sums, *[F.greatest(comes[name], was[name]).alias(name) for name in totals.latest],
        F.lit(False).alias("\0asked") if not totals.latest else F.greatest(
            *[F.coalesce((goes[name] >= was[name]) & (comes[name].isNull() | (comes[name] < was[name])), F.lit(False)) for name in totals.latest],
            F.lit(False),
        ).alias("\0asked"),
    )
    if totals.latest:
        # Three jobs ask for it below, and a task that also sorted for the joins above would hold all their memory at once.
        kept = written(kept, "kept")
    asked = kept.filter("`\0asked`") if totals.latest else None
    if asked is None or asked.isEmpty():
        return kept.drop("\0asked")
    seen = after.join(asked.select(group), group, "left_semi").groupBy(exact(group)).agg(
        *[F.max(F.expr(value)).alias(name) for name, value in totals.latest.items()]
    )
    redone = asked.drop("\0asked", *totals.latest).join(seen, group, "left")
    return kept.filter("NOT `\0asked`").drop("\0asked").unionByName(redone)


def merge_with_totals(
    store: Store, facts: str, df: DataFrame, key: str, totals: Totals, number: int | None = None
) -> LoadResult:
    """Merge rows into a table of facts by key, and what they change into the totals.

    Replaced facts are looked up by their keys, so lay the facts out in buckets: then only those that are touched are read. The totals
    are merged first, both under one batch `number` (by default the one after the facts' last), so a load that fails in between is
    finished by running it again, and nothing is counted twice. Facts without a group count nowhere; facts without a key are all added.
    """
    batch: Batch = (f"totals of {facts}", last_batch(store, facts, f"totals of {facts}") + 1 if number is None else number)
    exists = store.exists(facts)
    folder = f"{shared_dir(store.spark)}/totals_{uuid.uuid4().hex}"

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return store.spark.read.schema(rows.schema).parquet(f"{folder}/{name}")

    try:
        given = written(df, "given")
        if exists:
            given = align(given, store.table(facts), f"merge into {facts}")
            missing = [name for name in store.table(facts).columns if name not in given.columns]
            if missing:
                raise ValueError(f"merge into {facts}: totals need whole rows, {missing} are missing")
        require_unique(given, key, f"merge into {facts}")
        goes = rows_of_keys(store, facts, given, key) if exists else None
        changes = written(delta(given, goes, totals), "changes")
        stored = rows_of_keys(store, totals.table, changes, totals.group) if store.exists(totals.table) else None
        after = given if not exists else store.table(facts).join(given.select(exact(key)), key, "left_anti").unionByName(given)
        write_merge(store, totals.table, _settled(changes, stored, after, totals, written), totals.group, batch=batch)
        return write_merge(store, facts, given, key, batch=batch)
    finally:
        remove_folder(store.spark, folder)
