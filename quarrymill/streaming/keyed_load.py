"""Streams of changes landed by keyed state: a row that is late or repeated is known as such without looking at the table."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from quarrymill.functions.columns import exact, quoted
from quarrymill.sinks.store import Store, clone_empty, publish_view, write_replace
from quarrymill.streaming.file_load import land_stream

# Executors get the functions themselves, so that this package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# So many rows, or bytes, are thinned together, whatever the session's Arrow batches hold.
ROWS_THINNED, BYTES_THINNED = 10_000, 16 << 20

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class NewestOfKey(StatefulProcessor):
    """Lets a row through if its sequence is above all that its key has had. The state is that sequence, one per key."""

    def __init__(self, seq: str, kind: T.DataType):
        self.seq, self.kind = seq, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getValueState("newest", T.StructType([T.StructField("seq", self.kind)]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.newest.get() if self.newest.exists() else None
        best = None
        for row in rows:
            if best is None or _above(row[self.seq], best[self.seq]):
                best = row
        if best is not None and (known is None or _above(best[self.seq], known[0])):
            self.newest.update((best[self.seq],))
            yield best

    def close(self) -> None:
        pass


def _above(value, other) -> bool:
    """NULL is below all others, and not above itself."""
    return value is not None and (other is None or value > other)


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches put together."""
    held, n, size = [], 0, 0
    for batch in batches:
        held.append(batch)
        n, size = n + batch.num_rows, size + batch.nbytes
        if n >= ROWS_THINNED or size >= BYTES_THINNED:
            yield pa.concat_batches(held)
            held, n, size = [], 0, 0
    if held:
        yield pa.concat_batches(held)


def newest_in_batches(rows: DataFrame, key: str, seq: str) -> DataFrame:
    """Of some `ROWS_THINNED` rows each the newest of every key, so that a hot key is few rows before it is shuffled."""
    at_key, at_seq = rows.columns.index(key), rows.columns.index(seq)

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _together(batches):
            order = pc.sort_indices(
                pa.table({"k": batch.column(at_key), "s": batch.column(at_seq)}),
                sort_keys=[("k", "ascending"), ("s", "descending")],
                null_placement="at_end",
            )
            ordered = batch.column(at_key).take(order).dictionary_encode().indices
            first = pa.concat_arrays([pa.array([True]), pc.not_equal(ordered[1:], ordered[:-1])]) if len(ordered) else pa.array([], pa.bool_())
            yield batch.take(order.filter(first))

    return rows.mapInArrow(thin, rows.schema)


def newest_rows(arriving: DataFrame, key: str, seq: str) -> DataFrame:
    """A stream's rows that are newer than all its earlier ones of their key; rows without a key all pass."""
    keyed = arriving.filter(exact(key).isNotNull())
    processor = NewestOfKey(seq, arriving.schema[seq].dataType)
    winners = newest_in_batches(keyed, key, seq).groupBy(exact(key)).transformWithState(
        statefulProcessor=processor, outputStructType=arriving.schema, outputMode="Append", timeMode="None"
    )
    return winners.unionByName(arriving.filter(exact(key).isNull()))


def log_of(table: str) -> str:
    return f"{table}_log"


def stream_newest(store: Store, table: str, arriving: DataFrame, checkpoint: str, key: str, seq: str) -> StreamingQuery:
    """Land what has arrived of a stream of changes, then stop. The table shows the newest row of each key.

    Which row is newest is decided by state that the query keeps per key in its checkpoint: a row that is late, or has been there, goes no
    further, in this run or a later one, and no batch is joined against the table. Rows that win are appended to a log, whose parts the
    store folds; the table is a view of the newest row of each key in it, combined map-side. `compact_newest` shortens the log.

    A row whose `seq` equals its key's newest is a repeat. NULL is below all others. Rows without a key are all kept. State lives in
    RocksDB on the executors, so it may be larger than their memory; the session's setting for that is changed.
    """
    store.spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
    log = log_of(table)
    if not store.exists(log):
        clone_empty(store, log, store.spark.createDataFrame([], arriving.schema))
    if not store.exists(table):
        publish_view(store, table, _newest_sql(store, log, arriving.columns, key, seq))
    return land_stream(store, log, newest_rows(arriving, key, seq), checkpoint)


def _newest_sql(store: Store, log: str, columns: list[str], key: str, seq: str) -> str:
    k, s = quoted(key), quoted(seq)
    listed = ", ".join(map(quoted, columns))
    newest = f"max_by(struct({listed}), struct({s} IS NOT NULL, {s}))"
    return (
        f"SELECT row.* FROM (SELECT {newest} AS row FROM {store.name(log)} WHERE {k} IS NOT NULL GROUP BY {k}) "
        f"UNION ALL SELECT {listed} FROM {store.name(log)} WHERE {k} IS NULL"
    )


def compact_newest(store: Store, table: str) -> None:
    """Rewrite the log as the rows the table shows."""
    write_replace(store, log_of(table), store.table(table).select(*map(F.col, map(quoted, store.table(table).columns))))
