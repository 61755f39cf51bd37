"""Incremental landing of newly arrived files with Structured Streaming."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarrymill.sinks.store import Store, clone_empty, write_append, write_merge


def stream_load(
    store: Store,
    table: str,
    path: str,
    schema: T.StructType | str,
    checkpoint: str,
    strategy: str = "append",
    key: str | None = None,
    seq: str | None = None,
    file_format: str = "parquet",
    max_files: int = 1000,
) -> StreamingQuery:
    """Land every file of `path` that earlier runs have not landed, then stop.

    The checkpoint remembers the files. Batches land through the store like any other load, so that loads by batch and
    by stream may share a table. The table records the last batch of each query together with its
    rows, and a batch that runs again after a crash is skipped: either strategy is exactly-once.

    `max_files` sizes batches. With `seq`, a merge does not depend on how files fall into batches; without it every
    batch is one extract, in which a key may occur once.
    """
    if strategy == "merge" and not key:
        raise ValueError(f"{table}: merge requires primary_key")
    if strategy not in ("append", "merge"):
        raise ValueError(f"unknown load strategy {strategy!r}")
    spark = store.spark
    arriving = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
    )
    return land_stream(store, table, arriving, checkpoint, strategy, key, seq)


def land_stream(
    store: Store,
    table: str,
    arriving: DataFrame,
    checkpoint: str,
    strategy: str = "append",
    key: str | None = None,
    seq: str | None = None,
) -> StreamingQuery:
    """Land what has arrived of any streaming source, then stop; as `stream_load` does with files."""
    spark = store.spark
    if strategy == "append" and not store.exists(table):
        clone_empty(store, table, spark.createDataFrame([], arriving.schema))
    # The query's id outlives restarts but is known only once it runs; batches wait for it.
    query_id: list[str] = []
    known = threading.Event()

    def land(rows: DataFrame, batch_id: int) -> None:
        known.wait()
        batch = (query_id[0], batch_id)
        if strategy == "merge":
            write_merge(store, table, rows, key, seq, batch=batch)
        else:
            write_append(store, table, rows, batch=batch)

    query = (
        arriving.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_id.append(str(query.id))
    known.set()
    return query
