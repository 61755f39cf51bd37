"""High-water marks of incremental loads, and the load itself.

Marks are a table of one line per source and stream. A set writes it anew, with the new lines in place of the old ones of
their keys, and swaps it in; a clear leaves a line out. It is as small as there are streams, however often they are loaded.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.operators.quality import TestedModel, run_column_tests
from quarrymill.sinks.store import (
    LoadResult,
    Store,
    typed_create,
    write_append,
    write_merge,
    write_replace,
)

CURSOR_TABLE = "load_cursors"
_COLUMNS = {"source_name": "text", "stream": "text", "value": "text", "updated_at": "timestamptz"}


def cursor_key(stream: str, field: str) -> str:
    return f"{stream}:{field}"


def set_cursors(store: Store, marks: DataFrame) -> None:
    """Set several marks at once: rows of (source_name, stream, value); a NULL value clears."""
    now = datetime.now(timezone.utc)
    lines = marks.select(
        "source_name", "stream", F.col("value").cast("string").alias("value"), F.lit(now).alias("updated_at")
    )
    # What is stored is read by the write that replaces it, so a mark is never missing in between.
    write_replace(store, CURSOR_TABLE, _newest(cursors(store).unionByName(lines)).coalesce(1))


def _newest(lines: DataFrame) -> DataFrame:
    newest = lines.groupBy("source_name", "stream").agg(
        F.max_by("value", "updated_at").alias("value"), F.max("updated_at").alias("updated_at")
    )
    return newest.filter(F.col("value").isNotNull())


def cursors(store: Store) -> DataFrame:
    """The marks that are set: (source_name, stream, value, updated_at)."""
    typed_create(store, CURSOR_TABLE, _COLUMNS)
    return store.table(CURSOR_TABLE)


def compact_cursors(store: Store) -> None:
    """Rewrite the table as it is. Sets keep it small; nothing depends on this."""
    write_replace(store, CURSOR_TABLE, cursors(store).coalesce(1))


def _mark(store: Store, source: str, stream: str, value: str | None) -> DataFrame:
    return store.spark.createDataFrame(
        [(source, stream, value)], "source_name string, stream string, value string"
    )


def cursor_get(store: Store, source: str, stream: str) -> str | None:
    of_key = (F.col("source_name") == source) & (F.col("stream") == stream)
    row = cursors(store).filter(of_key).first()
    return row["value"] if row else None


def cursor_set(store: Store, source: str, stream: str, value: str) -> None:
    set_cursors(store, _mark(store, source, stream, value))


def cursor_clear(store: Store, source: str, stream: str) -> None:
    set_cursors(store, _mark(store, source, stream, None))


def next_cursor(df: DataFrame, cursor: str, previous: str | None = None) -> DataFrame:
    """One row, `value`: the greatest cursor of the batch and the previous mark, as text.

    Compared as the column's own type. NULL cursors do not count.
    """
    return df.agg(_greatest(df, cursor, previous).alias("value"))


def _greatest(df: DataFrame, cursor: str, previous: str | None) -> Column:
    before = F.lit(previous).cast(df.schema[cursor].dataType)
    return F.greatest(F.max(F.col(cursor)), before).cast("string")


@dataclass(frozen=True)
class StreamConfig:
    """What a source declares about one of its streams.

    `inclusive` extracts rows at the mark again, so that rows that arrive later with the mark's value are not lost;
    it needs a merge, which absorbs those that were there. `identifier` and `schema` name the table of a
    database stream where it differs from the stream's name.
    """

    write_disposition: str = "append"
    primary_key: str | Sequence[str] | None = None
    cursor_field: str | None = None
    inclusive: bool = False
    identifier: str | None = None
    schema: str | None = None
    initial_value: str | None = None
    column_tests: dict[str, Sequence[str]] | None = None

    def key(self) -> str | None:
        if self.primary_key is None or isinstance(self.primary_key, str):
            return self.primary_key or None
        if len(self.primary_key) > 1:
            raise ValueError(f"composite primary_key is not supported: {list(self.primary_key)}")
        return self.primary_key[0] if self.primary_key else None


# Gets the mark to start after. Streams that are `inclusive` filter by `scan_cursor(..., inclusive=True)`.
Extract = Callable[[str | None], DataFrame]


def raw_table(source: str, stream: str) -> str:
    return f"raw_{source}_{stream.replace('.', '_')}"


def load_stream(
    store: Store,
    source: str,
    stream: str,
    extract: Extract,
    config: StreamConfig = StreamConfig(),
    strategy: str | None = None,
    unique_key: str | None = None,
    seq: str | None = None,
    full_refresh: bool = False,
) -> LoadResult:
    """Extract past the stored mark, land by strategy, then move the mark.

    `extract` gets the mark to start after, or None for everything. The new mark is observed by
    the write that lands the rows, so nothing is read twice, and it is stored only after those
    rows are published: a crash in between loads them again, which `merge` absorbs. It never falls: late
    rows below the stored mark leave it where it is.
    """
    config = replace(config, write_disposition=strategy or config.write_disposition)
    if full_refresh:
        return full_refresh_stream(store, source, stream, extract, config)
    return _load(store, source, stream, extract, config, unique_key or config.key(), seq)


def full_refresh_stream(
    store: Store, source: str, stream: str, extract: Extract, config: StreamConfig = StreamConfig()
) -> LoadResult:
    """Forget the mark the stream uses and replace the table by a whole extract."""
    if config.cursor_field:
        cursor_clear(store, source, cursor_key(stream, config.cursor_field))
    return _load(store, source, stream, extract, replace(config, write_disposition="replace"), None, None)


def _load(
    store: Store,
    source: str,
    stream: str,
    extract: Extract,
    config: StreamConfig,
    key: str | None,
    seq: str | None,
) -> LoadResult:
    target = raw_table(source, stream)
    field = config.cursor_field
    stored = cursor_get(store, source, cursor_key(stream, field)) if field else None
    batch = extract(stored if stored is not None else config.initial_value)
    previous = None if config.write_disposition == "replace" else stored
    measures = {"high": _greatest(batch, field, previous)} if field else None
    if config.inclusive and config.write_disposition == "append":
        raise ValueError(f"{source}.{stream}: inclusive cursors need a merge by primary_key")

    if config.write_disposition == "merge":
        if not key:
            raise ValueError(f"{source}.{stream}: merge requires primary_key")
        result = write_merge(store, target, batch, key, seq, measures)
    elif config.write_disposition == "replace":
        result = write_replace(store, target, batch, measures)
    elif config.write_disposition == "append":
        result = write_append(store, target, batch, measures)
    else:
        raise ValueError(f"unknown load strategy {config.write_disposition!r}")

    if field and result.measured["high"] is not None:
        cursor_set(store, source, cursor_key(stream, field), result.measured["high"])
    return result


def load_streams(
    store: Store,
    source: str,
    streams: Mapping[str, StreamConfig],
    extract_of: Callable[[str, StreamConfig], Extract],
    full_refresh: bool = False,
) -> list[LoadResult]:
    """Load every declared stream, in the order of declaration."""
    return [
        load_stream(store, source, name, extract_of(name, config), config, full_refresh=full_refresh)
        for name, config in streams.items()
    ]


def run_source_tests(store: Store, source: str, streams: Mapping[str, StreamConfig]) -> DataFrame:
    """The column tests that streams declare, run on their raw tables."""
    tested = [
        TestedModel(raw_table(source, stream), store.table(raw_table(source, stream)), config.column_tests)
        for stream, config in streams.items()
        if config.column_tests
    ]
    return run_column_tests(store.spark, tested)
