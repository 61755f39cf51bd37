"""Tables as versions behind a view.

A table `m` is a view over immutable Parquet tables `m__v<run>`, its parts. Whatever changes the table
writes a new part or a new version in full and then replaces the view, which is one catalog operation: a
reader sees the old rows or the new ones, after an append as well. A job that fails half-way leaves the view
where it was. Views that other people build on `m` bind by name and survive. One writer per
table at a time is assumed.

Appends add parts. Whenever the newest `FOLDED_PARTS` of them have been folded equally often, they become one, so that
there are few of them after any number of appends and a row is rewritten a logarithmic number of times; `compact` folds all. A merge writes a new version, or, if the caller asks for
`apart`, only the changed rows as `m__c<run>`: the view is then the parts without the changed keys, and the
changes. Which of the two it is never depends on sizes, and readers get no hints.

A table that `lay_out_buckets` has dealt into partitions by a hash of its key is merged in place: only the partitions
that hold keys of the batch are read and overwritten. What they become is written beside the table first and named in the
view's properties, so that a merge that fails while it overwrites is finished by the next one.

The view's properties name what it reads, and the last batch of each streaming query that was landed, so
that a batch that runs again after a crash changes nothing. The superseded version is kept for readers that still
use it, older ones are dropped (`GRACE_VERSIONS`).
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.functions.columns import exact, quoted
from quarrymill.functions.types import spark_type
from quarrymill.operators.upsert import (
    KeyFacts,
    align,
    latest_per_key,
    newer_than_stored,
    require_unique,
    touched,
    upsert,
    with_carried,
)
from quarrymill.session import shared_dir

# Superseded versions that are left for readers that have begun before a change.
GRACE_VERSIONS = 1
# Parts that are folded into one.
FOLDED_PARTS = 16

_CURRENT = "quarrymill.current"
_CHANGES = "quarrymill.changes"
_CHANGES_KEY = "quarrymill.changes_key"
# Parts that were appended after the changes, which therefore hide none of their rows.
_AFTER = "quarrymill.after_changes"
# How often each part has been folded.
_TIERS = "quarrymill.tiers"
_UNIQUE = "quarrymill.unique_key"
_BATCH = "quarrymill.batch."
_BUCKETS = "quarrymill.buckets"
_PENDING = "quarrymill.pending"
# Partition columns of a bucketed table, which its view leaves out. Rows without a key have a partition per load.
_BUCKET, _LOAD = "_quarrymill_bucket", "_quarrymill_load"
_UNKEYED, _KEYED = -1, "keyed"

# A streaming query's id and the number of one of its batches.
Batch = tuple[str, int]


@dataclass(frozen=True)
class LoadResult:
    """One finished load. `measured` holds whatever else was observed while it wrote."""

    target: str
    rows: int
    duration_ms: int
    measured: dict


def load_summary(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    """One row per load: target, rows, duration."""
    return spark.createDataFrame(
        [(r.target, r.rows, r.duration_ms) for r in results],
        "target string, rows bigint, duration_ms bigint",
    )


@dataclass(frozen=True)
class Store:
    """A database of the session catalog that the loads and models write to."""

    spark: SparkSession
    database: str

    def name(self, table: str) -> str:
        return f"{quoted(self.database)}.{quoted(table)}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def table(self, table: str) -> DataFrame:
        """Scan a published table or view by name."""
        return self.spark.table(self.name(table))

    def properties(self, table: str) -> dict[str, str]:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return {row["key"]: row["value"] for row in rows}

    def versions(self, table: str) -> list[str]:
        """The physical tables that are or were behind a published table."""
        rows = self.spark.sql(f"SHOW TABLES IN {quoted(self.database)} LIKE '{table}__*'").collect()
        own = re.compile(re.escape(table) + r"__[vc]\d{20}", re.IGNORECASE)
        return sorted(row["tableName"] for row in rows if own.fullmatch(row["tableName"]))


def open_store(spark: SparkSession, database: str, location: str | None = None) -> Store:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{where}")
    return Store(spark, database)


def scratch_store(spark: SparkSession, purpose: str) -> Store:
    """A new, empty store in the shared folder, for one run."""
    database = f"qm_{purpose}_{uuid.uuid4().hex[:12]}"
    return open_store(spark, database, f"{shared_dir(spark)}/{database}")


def _write_version(
    store: Store,
    table: str,
    df: DataFrame,
    measures: dict[str, Column] | None = None,
    kind: str = "v",
) -> tuple[str, dict]:
    """Write the next version; rows and `measures` are observed by the write itself."""
    version = f"{table}__{kind}{time.time_ns():020d}"
    seen = Observation()
    _observed(df, seen, measures).write.format("parquet").mode("error").saveAsTable(store.name(version))
    return version, seen.get


def _observed(df: DataFrame, seen: Observation, measures: dict[str, Column] | None) -> DataFrame:
    extra = [column.alias(name) for name, column in (measures or {}).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra)


def _parts(marks: dict[str, str]) -> list[str]:
    return marks[_CURRENT].split(",")


def _listed(marks: dict[str, str], key: str) -> list[str]:
    return marks[key].split(",") if marks.get(key) else []


def _point(store: Store, table: str, marks: dict[str, str | None], grace: int = GRACE_VERSIONS) -> None:
    """Make the view show what the marks say, in one catalog operation, and drop what is long superseded."""
    kept = {key: value for key, value in marks.items() if value is not None}
    listed = ", ".join(f"'{key}' = {_literal(value)}" for key, value in kept.items())
    parts = [store.name(part) for part in _parts(kept)]
    columns = ", ".join(quoted(c) for c in store.table(_parts(kept)[0]).columns if c not in (_BUCKET, _LOAD))
    if _CHANGES in kept:
        changes, key = store.name(kept[_CHANGES]), quoted(kept[_CHANGES_KEY])
        keys = f"(SELECT {key} FROM {changes} WHERE {key} IS NOT NULL)"
        reads = [f"SELECT {columns} FROM {part} v LEFT ANTI JOIN {keys} c ON v.{key} = c.{key}" for part in parts]
        after = [store.name(part) for part in _listed(kept, _AFTER)]
        reads += [f"SELECT {columns} FROM {part}" for part in (changes, *after)]
    else:
        reads = [f"SELECT {columns} FROM {part}" for part in parts]
    store.spark.sql(
        f"CREATE OR REPLACE VIEW {store.name(table)} TBLPROPERTIES ({listed}) AS {' UNION ALL '.join(reads)}"
    )
    stale = _superseded(store, table)
    for version in stale[: max(0, len(stale) - grace)]:
        store.spark.sql(f"DROP TABLE {store.name(version)}")


def _superseded(store: Store, table: str) -> list[str]:
    """Versions the view does not read, oldest first."""
    in_use = _in_use(store, table)
    return sorted((v for v in store.versions(table) if v not in in_use), key=lambda v: v[-20:])


def _literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _marks(store: Store, table: str) -> dict[str, str]:
    marks = {k: v for k, v in store.properties(table).items() if k.startswith("quarrymill.")}
    if _CURRENT not in marks:
        raise ValueError(f"{table} is a plain view; only published tables can be loaded into")
    return marks


def _in_use(store: Store, table: str) -> set[str]:
    marks = _marks(store, table)
    return {*_parts(marks), *_listed(marks, _AFTER), *(marks[kind] for kind in (_CHANGES, _PENDING) if kind in marks)}


def _landed(store: Store, table: str, batch: Batch | None) -> dict[str, str]:
    """The marks of landed batches of a published table, with `batch` among them."""
    marks = _marks(store, table) if store.exists(table) else {}
    landed = {key: value for key, value in marks.items() if key.startswith(_BATCH)}
    return landed | ({_BATCH + batch[0]: str(batch[1])} if batch else {})


def _has_landed(store: Store, table: str, batch: Batch | None) -> bool:
    """Whether this batch or a later one of its query is part of the table."""
    if batch is None or not store.exists(table):
        return False
    return int(_marks(store, table).get(_BATCH + batch[0], -1)) >= batch[1]


def last_batch(store: Store, table: str, query: str) -> int:
    """The number of the last batch of `query` that has landed in the table; -1 if none has."""
    return int(_marks(store, table).get(_BATCH + query, -1)) if store.exists(table) else -1


def rows_of_keys(store: Store, table: str, keys: DataFrame, key: str) -> DataFrame:
    """The stored rows that have one of these keys. Of a table in buckets by this key only theirs are read."""
    _finish_pending(store, table)
    marks, rows = _marks(store, table), store.table(table)
    wanted = keys.filter(exact(key).isNotNull()).select(exact(key)).distinct()
    if _BUCKETS in marks and marks[_UNIQUE] == key:
        bucket = _bucketed(wanted, key, int(marks[_BUCKETS]), "").select(_BUCKET).distinct()
        hit = sorted(row[0] for row in bucket.collect())
        rows = store.table(marks[_CURRENT]).filter(F.col(_BUCKET).isin(hit)).select(*map(exact, rows.columns))
    return rows.join(wanted, key, "left_semi")


def _nothing(store: Store, table: str, started: float, measures: dict[str, Column] | None) -> LoadResult:
    return _finish(store, table, {"rows": 0, **dict.fromkeys(measures or {})}, started)


def _finish(store: Store, table: str, measured: dict, started: float) -> LoadResult:
    extra = dict(measured)
    rows = extra.pop("rows")
    took = round((time.monotonic() - started) * 1000)
    return LoadResult(f"{store.database}.{table}", rows, took, extra)


def drop_superseded(store: Store, table: str) -> list[str]:
    """Drop all versions the view no longer reads, once nobody else reads them either."""
    stale = _superseded(store, table)
    for version in stale:
        store.spark.sql(f"DROP TABLE {store.name(version)}")
    return stale


def compact(store: Store, table: str, sort_by: str | None = None, grace: int = GRACE_VERSIONS) -> None:
    """Fold parts and changes into one version; AQE sizes the new files.

    Sorted by the merge key, files cover disjoint key ranges, and later merges and look-ups skip
    those they cannot need. Rows with equal keys, or none, are spread by a hash of their values.
    """
    _finish_pending(store, table)
    marks, rows = _marks(store, table), store.table(table)
    if _BUCKETS in marks:
        lay_out_buckets(store, table, marks[_UNIQUE], int(marks[_BUCKETS]), grace)
        return
    if sort_by:
        hashable = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
        spread = F.xxhash64(*map(exact, hashable))
        rows = rows.repartitionByRange(exact(sort_by), spread).sortWithinPartitions(exact(sort_by))
    else:
        rows = rows.hint("rebalance")
    version, _ = _write_version(store, table, rows)
    _point(store, table, {**marks, _CURRENT: version} | _ONE_PART, grace)


# What a table that has been written as one part no longer has.
_ONE_PART = {_CHANGES: None, _CHANGES_KEY: None, _AFTER: None, _TIERS: None}


def _fold_parts(store: Store, table: str) -> None:
    """Make one part of the newest ones while `FOLDED_PARTS` of them have been folded equally often."""
    while True:
        marks = _marks(store, table)
        parts = _parts(marks)
        tiers = [int(t) for t in _listed(marks, _TIERS)] or [0] * len(parts)
        if _CHANGES in marks or len(parts) < FOLDED_PARTS or len(set(tiers[-FOLDED_PARTS:])) > 1:
            return
        rows = reduce(DataFrame.unionAll, [store.table(part) for part in parts[-FOLDED_PARTS:]])
        folded, _ = _write_version(store, table, rows.hint("rebalance"))
        tiers = [*tiers[:-FOLDED_PARTS], tiers[-1] + 1]
        marks = {**marks, _CURRENT: ",".join([*parts[:-FOLDED_PARTS], folded]), _TIERS: ",".join(map(str, tiers))}
        # Readers that have begun still use all of the parts.
        _point(store, table, marks, GRACE_VERSIONS + FOLDED_PARTS)


# --- materializations -------------------------------------------------------------------------


def typed_create(store: Store, table: str, columns: dict[str, str | None]) -> None:
    """An empty table with the given warehouse types; no type means text. Keeps what exists."""
    if store.exists(table):
        return
    fields = [
        T.StructField(name, T.DataType.fromDDL(spark_type(kind or "text")))
        for name, kind in columns.items()
    ]
    clone_empty(store, table, store.spark.createDataFrame([], T.StructType(fields)))


def clone_empty(store: Store, table: str, like: DataFrame) -> None:
    """An empty table with another one's columns."""
    version, _ = _write_version(store, table, like.limit(0))
    _point(store, table, {_CURRENT: version})


def publish_view(store: Store, view: str, model: str) -> None:
    """The default materialization: SQL text that whoever reads the view evaluates.

    The catalog can keep text only; a DataFrame is an error.
    """
    if not isinstance(model, str):
        raise TypeError(f"{view}: a view is published as SQL text; publish_table takes a DataFrame")
    store.spark.sql(f"CREATE OR REPLACE VIEW {store.name(view)} AS {model}")


def publish_table(
    store: Store,
    table: str,
    df: DataFrame,
    measures: dict[str, Column] | None = None,
    grace: int = GRACE_VERSIONS,
) -> LoadResult:
    """Build the whole result, then swap it in. `grace` superseded versions stay for their readers."""
    started = time.monotonic()
    version, measured = _write_version(store, table, df, measures)
    _point(store, table, {_CURRENT: version} | _landed(store, table, None), grace)
    return _finish(store, table, measured, started)


def publish_incremental(
    store: Store, table: str, df: DataFrame, unique_key: str | None, apart: bool = False
) -> LoadResult:
    """Upsert the model's result by key, laid out as in `write_merge`. Rows that are gone from it stay.

    Strict: a key that occurs twice in the result is an error, as is a column the table lacks.
    """
    if not unique_key:
        raise ValueError(f"{table}: incremental requires unique_key")
    return _merge(store, table, df, unique_key, None, apart=apart)


def preview(store: Store, table: str, n: int = 10, order_by: list | None = None) -> DataFrame:
    rows = store.table(table)
    return (rows.orderBy(*order_by) if order_by else rows).limit(n)


# --- load strategies --------------------------------------------------------------------------


def write_replace(
    store: Store, table: str, df: DataFrame, measures: dict[str, Column] | None = None
) -> LoadResult:
    """Swap in the batch as the whole table; an empty batch gives an empty table."""
    return publish_table(store, table, df, measures)


def write_append(
    store: Store,
    table: str,
    df: DataFrame,
    measures: dict[str, Column] | None = None,
    batch: Batch | None = None,
) -> LoadResult:
    """Add the rows as a part of their own, creating the table if there is none. No dedup.

    Columns the rows lack become NULL; a column the table lacks is an error. Changes that are kept apart
    hide nothing of what is appended after them. A streamed `batch` that has landed is skipped.
    """
    started = time.monotonic()
    if _has_landed(store, table, batch):
        return _nothing(store, table, started, measures)
    if not store.exists(table):
        version, seen = _write_version(store, table, df, measures)
        _point(store, table, {_CURRENT: version} | _landed(store, table, batch))
        return _finish(store, table, seen, started)
    if _BUCKETS in _marks(store, table):
        raise ValueError(f"{table} is laid out in buckets by key; it is loaded by merge")
    marks = _marks(store, table)
    target = store.table(_parts(marks)[0])
    aligned = align(df, target, f"append to {table}")
    filled = aligned.select(
        *[
            exact(field.name)
            if field.name in aligned.columns
            else F.lit(None).cast(field.dataType).alias(field.name)
            for field in target.schema.fields
        ]
    )
    part, seen = _write_version(store, table, filled, measures)
    if _CHANGES in marks:
        added = {_AFTER: ",".join([*_listed(marks, _AFTER), part])}
    else:
        tiers = _listed(marks, _TIERS) or ["0"] * len(_parts(marks))
        added = {_CURRENT: f"{marks[_CURRENT]},{part}", _TIERS: ",".join([*tiers, "0"])}
    _point(store, table, {**marks, **added, _UNIQUE: None} | _landed(store, table, batch))
    _fold_parts(store, table)
    return _finish(store, table, seen, started)


def write_merge(
    store: Store,
    table: str,
    df: DataFrame,
    key: str | list[str],
    seq: str | None = None,
    measures: dict[str, Column] | None = None,
    apart: bool = False,
    batch: Batch | None = None,
) -> LoadResult:
    """Upsert the rows by one key column.

    Without `seq` the rows are one extract and a key twice in them is an error. With `seq`, which numbers extracts,
    the greatest one of a key wins, among the rows and against the stored row, so that the order in which
    batches arrive does not matter; only a key twice with one `seq` is an error. NULL is below all others, and of
    equal ones the arriving row wins. An update takes the new value even when that is NULL. NULL keys
    are always appended.

    The result is a new version of the table. With `apart` the changed rows are kept beside it instead: the merge
    then writes no more than them, and every reader joins against their keys until `compact`. A streamed
    `batch` that has landed is skipped.
    """
    if isinstance(key, list):
        if len(key) != 1:
            raise ValueError(f"merge needs exactly one key column, got {key}")
        key = key[0]
    return _merge(store, table, df, key, seq, measures, apart, batch)


def _merge(
    store: Store,
    table: str,
    df: DataFrame,
    key: str,
    seq: str | None,
    measures: dict[str, Column] | None = None,
    apart: bool = False,
    batch: Batch | None = None,
) -> LoadResult:
    """Write the rows once, check them, write what changes, point at it.

    They are written first because the merge reads them more than once, and a source read twice
    may answer differently. Where they need no further work they become part of the table as they are.
    """
    started = time.monotonic()
    what = f"merge into {table}"
    if _has_landed(store, table, batch):
        return _nothing(store, table, started, measures)
    if store.exists(table):
        _finish_pending(store, table)
    staged, seen = _write_version(store, table, df, measures, kind="c")
    pointed = False
    try:
        given = store.table(staged)
        exists = store.exists(table)
        as_is = not exists or given.dtypes == store.table(table).dtypes
        if not as_is:
            # First of all: keys that differ as text may be equal as the table's type.
            given = align(given, store.table(table), what)
        if exists and not seen["rows"]:
            if batch:
                _point(store, table, _marks(store, table) | _landed(store, table, batch))
            return _finish(store, table, seen, started)
        facts = require_unique(given, key, what, seq)
        fresh, as_is = (given, as_is) if seq is None else (latest_per_key(given, key, seq), False)
        if exists:
            _merge_into(store, table, fresh, key, seq, facts, apart, staged if as_is else None, batch)
        elif as_is:
            _point(store, table, {_CURRENT: staged, _UNIQUE: key} | _landed(store, table, batch))
        else:
            version, _ = _write_version(store, table, fresh)
            _point(store, table, {_CURRENT: version, _UNIQUE: key} | _landed(store, table, batch))
        pointed = True
    finally:
        if not pointed or staged not in _in_use(store, table):
            store.spark.sql(f"DROP TABLE IF EXISTS {store.name(staged)}")
    return _finish(store, table, seen, started)


def _merge_into(
    store: Store,
    table: str,
    fresh: DataFrame,
    key: str,
    seq: str | None,
    facts: KeyFacts,
    apart: bool,
    as_is: str | None,
    batch: Batch | None,
) -> None:
    """Merge aligned rows. `as_is` names the table that already holds exactly them, if there is one.

    Stored rows are looked at where the rows' keys are: the check for stored duplicates and the comparison
    of `seq` read the key column and shuffle no more than the rows that match.
    """
    marks, base = _marks(store, table), store.table(table)
    if _BUCKETS in marks:
        _merge_buckets(store, table, fresh, key, seq, facts, marks | _landed(store, table, batch))
        return
    if marks.get(_UNIQUE) != key:
        require_unique(touched(base, fresh, key, facts), key, f"existing rows of {table}")
    if seq is not None and seq in base.columns:
        fresh = newer_than_stored(base, fresh, key, seq, facts)
    marks = marks | _landed(store, table, batch)
    if not apart:
        version, _ = _write_version(store, table, upsert(base, fresh, key, facts))
        unique = key if marks.get(_UNIQUE) == key else None
        _point(store, table, {**marks, _CURRENT: version, _UNIQUE: unique} | _ONE_PART)
        return
    if marks.get(_CHANGES_KEY, key) != key:
        raise ValueError(f"{table} keeps changes apart by {marks[_CHANGES_KEY]!r}; compact it to merge by {key!r}")
    if as_is and _CHANGES not in marks:
        changes = as_is
    else:
        full = with_carried(base, fresh, key, facts).select(*map(exact, base.columns))
        if _CHANGES in marks:
            full = upsert(store.table(marks[_CHANGES]), full, key, facts)
        changes, _ = _write_version(store, table, full, kind="c")
    if _AFTER in marks:
        # The new changes hide rows of these parts, the older ones do not: what is hidden is left out for good.
        after = reduce(DataFrame.unionAll, map(store.table, _listed(marks, _AFTER)))
        rest, _ = _write_version(store, table, after.join(fresh.select(exact(key)), key, "left_anti").select(*map(exact, base.columns)))
        marks = {**marks, _AFTER: rest}
    unique = key if marks.get(_UNIQUE) == key else None
    _point(store, table, {**marks, _CHANGES: changes, _CHANGES_KEY: key, _UNIQUE: unique})


# --- buckets ----------------------------------------------------------------------------------


def _bucketed(rows: DataFrame, key: str, buckets: int, load: str) -> DataFrame:
    """The rows with their partition: a bucket by a hash of the key, or, without a key, one of this load."""
    keyed = exact(key).isNotNull()
    bucket = F.when(keyed, F.pmod(F.xxhash64(exact(key)), F.lit(buckets))).otherwise(_UNKEYED)
    return rows.withColumn(_BUCKET, bucket.cast("int")).withColumn(_LOAD, F.when(keyed, _KEYED).otherwise(load))


def lay_out_buckets(store: Store, table: str, key: str, buckets: int, grace: int = GRACE_VERSIONS) -> None:
    """Deal a published table into `buckets` partitions by key: from now on a merge rewrites those it touches, and no others.

    The table is rewritten once, and its keys are checked to be unique. Choose as many buckets as give files of some
    hundred megabytes; a merge whose keys are spread over all of them rewrites all of them.
    """
    _finish_pending(store, table)
    marks, rows = _marks(store, table), store.table(table)
    require_unique(rows, key, f"existing rows of {table}")
    version = f"{table}__v{time.time_ns():020d}"
    dealt = _bucketed(rows, key, buckets, version).hint("rebalance", F.col(_BUCKET))
    dealt.write.format("parquet").partitionBy(_BUCKET, _LOAD).saveAsTable(store.name(version))
    kept = {**marks, _CURRENT: version, _UNIQUE: key, _BUCKETS: str(buckets)} | _ONE_PART
    _point(store, table, kept, grace)


def _merge_buckets(
    store: Store, table: str, fresh: DataFrame, key: str, seq: str | None, facts: KeyFacts, marks: dict[str, str]
) -> None:
    """Merge aligned rows into the partitions their keys are in. At most one short row per bucket comes to the driver."""
    if marks[_UNIQUE] != key:
        raise ValueError(f"{table} is laid out in buckets by {marks[_UNIQUE]!r}; it cannot be merged by {key!r}")
    buckets, version = int(marks[_BUCKETS]), marks[_CURRENT]
    keys = _bucketed(fresh.filter(exact(key).isNotNull()).select(exact(key)), key, buckets, "")
    hit = sorted(row[0] for row in keys.select(_BUCKET).distinct().collect())
    columns = [exact(name) for name in store.table(table).columns]
    base = store.table(version).filter(F.col(_BUCKET).isin(hit)).select(*columns)
    if seq is not None and seq in base.columns:
        fresh = newer_than_stored(base, fresh, key, seq, facts)
    pending = f"{table}__c{time.time_ns():020d}"
    merged = _bucketed(upsert(base, fresh, key, facts), key, buckets, pending)
    merged.hint("rebalance", F.col(_BUCKET)).write.format("parquet").saveAsTable(store.name(pending))
    _point(store, table, marks | {_PENDING: pending})
    _finish_pending(store, table)


def _finish_pending(store: Store, table: str) -> None:
    """Overwrite the partitions that a merge has prepared, now or after it failed half-way. Doing it twice changes nothing."""
    marks = _marks(store, table)
    if _PENDING not in marks:
        return
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = store.spark.conf.get(setting)
    store.spark.conf.set(setting, "dynamic")
    try:
        prepared = store.table(marks[_PENDING]).select(*map(exact, store.table(marks[_CURRENT]).columns))
        prepared.hint("rebalance", F.col(_BUCKET)).write.mode("overwrite").insertInto(store.name(marks[_CURRENT]))
    finally:
        store.spark.conf.set(setting, before)
    pending = marks.pop(_PENDING)
    _point(store, table, marks)
    store.spark.sql(f"DROP TABLE IF EXISTS {store.name(pending)}")
