"""Tables of texts dealt into slabs: rows that each hold the documents of some megabytes, which later steps join by slab."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quarrymill.llm.bytewords import buffers
from quarrymill.llm.common import shared_path


def slabs_of(rows: DataFrame, slab_bytes: int) -> DataFrame:
    """slab, bytes and, for each column, an array of its values: the rows dealt, where they lie, into groups of about `slab_bytes`.

    `rows` has a column `text` without NULLs. Every task numbers its own slabs, so that they are the same if it runs again.
    """
    at_text = rows.columns.index("text")

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def slab():
            table = pa.Table.from_batches(held).combine_chunks()
            ends = pa.array([0, table.num_rows], pa.int32())
            values = [pa.ListArray.from_arrays(ends, pa.concat_arrays(c.chunks)) for c in table.columns]
            return pa.record_batch(
                [pa.array([(task << 32) + number]), pa.array([size]), *values],
                names=["slab", "bytes", *[f"{c}s" for c in table.column_names]],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            _, offsets = buffers(batch.column(at_text))
            size += int(offsets[-1] - offsets[0])
            if size >= slab_bytes:
                yield slab()
                number, held, size = number + 1, [], 0
        if held:
            yield slab()

    arrays = [f"{f.name}s array<{f.dataType.simpleString()}>" for f in rows.schema.fields]
    return rows.mapInArrow(dealt, ", ".join(["slab long, bytes long", *arrays]))


def kept_slabs(slabs: DataFrame, buckets: int) -> DataFrame:
    """The slabs as a table in the shared folder that is bucketed by slab: joins by slab leave the texts where they are."""
    spark, name = slabs.sparkSession, f"slabs_{uuid.uuid4().hex}"
    writer = slabs.write.format("parquet").option("path", shared_path(spark, "slabs")).option("compression", "zstd")
    writer.bucketBy(buckets, "slab").saveAsTable(name)
    return spark.table(name)


def texts_of(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts of one slab."""
    data, offsets = buffers(batch.column("texts")[row].values)
    return data, offsets.astype(np.int64)
