"""CSV with line breaks inside fields, read by as many tasks as a file has splits.

Whether a line begins inside quotes depends on all text before it. But each line only maps one answer to another: what
holds at its end if it begins outside quotes, and if it begins inside. Those maps compose. So every split folds its
lines to one map, the maps of a file's splits are folded in order, and then each split knows how it begins and cuts its lines
into records by itself. Only a record that spans splits is put together from their pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.session import ship

# What may follow the first quote of a field up to its end, and whole fields up to a comma.
_QUOTED = '(?:[^"]|"")*'
_AFTER = '(?:[^,"][^,]*)?'
_FIELDS = f'(?:(?:"{_QUOTED}"{_AFTER}|[^",][^,]*)?,)*'
# A line that begins outside quotes, or inside, and leaves a quoted field open.
OPENS = f'^{_FIELDS}"{_QUOTED}$'
STAYS_OPEN = f'^{_QUOTED}(?:"{_AFTER},{_FIELDS}"{_QUOTED})?$'

_SPLIT = "file string, start long"
_PIECE = f"{_SPLIT}, head boolean, tail boolean, first boolean, record string"


def line_maps(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each line, whether it ends inside quotes if it begins outside them, and if it begins inside."""
    opens, stays = np.zeros(len(lines), bool), np.ones(len(lines), bool)
    quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
    if len(quoted):
        own = lines.take(pa.array(quoted))
        opens[quoted] = pc.match_substring_regex(own, OPENS).to_numpy(zero_copy_only=False)
        stays[quoted] = pc.match_substring_regex(own, STAYS_OPEN).to_numpy(zero_copy_only=False)
    return opens, stays


def inside_after(opens: np.ndarray, stays: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each line of a run ends inside quotes, if the first begins so.

    A line either settles the answer or passes it on, turned or not; so it is the last settled answer, turned as often as lines
    have turned it since.
    """
    settles = opens == stays
    last = np.maximum.accumulate(np.where(settles, np.arange(len(opens)), -1))
    turned = np.cumsum(~settles & opens)
    before = np.where(last >= 0, turned[last], 0)
    return np.where(last >= 0, opens[last], inside) ^ ((turned - before) % 2 == 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the split they are read in. Lines of one split arrive in order, in one task."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value"
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, pa.Array]]:
    """(file, start, lines) of parts of batches that belong to one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, start = batch.column(0), batch.column(1)
        same = pc.and_(pc.equal(file[1:], file[:-1]), pc.equal(start[1:], start[:-1]))
        cuts = [0, *(np.flatnonzero(~same.to_numpy(zero_copy_only=False)) + 1).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            yield file[low].as_py(), start[low].as_py(), batch.column(2)[low:high]


def _split_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (file, start), runs in groupby(_runs(batches), key=lambda run: run[:2]):
        ends, returns = [False, True], None
        for _, _, lines in runs:
            returns = lines[0].as_py().endswith("\r") if returns is None else returns
            opens, stays = line_maps(lines)
            ends = [bool(inside_after(opens, stays, end)[-1]) for end in ends]
        yield pa.record_batch(
            [pa.array([file]), pa.array([start]), pa.array([ends[0]]), pa.array([ends[1]]), pa.array([returns])],
            names=["file", "start", "from_outside", "from_inside", "returns"],
        )


def split_states(lines: DataFrame) -> dict[tuple[str, int], tuple[bool, bool]]:
    """Whether each split begins inside quotes, and whether its file ends lines by carriage return and line feed, as its first line does.

    One short row per split comes back, and they are folded in file order.
    """
    shape = f"{_SPLIT}, from_outside boolean, from_inside boolean, returns boolean"
    maps = sorted(lines.mapInArrow(_split_maps, shape).collect(), key=lambda r: (r["file"], r["start"]))
    states = {}
    for file, rows in groupby(maps, key=lambda r: r["file"]):
        inside, returns = False, None
        for row in rows:
            returns = row["returns"] if returns is None else returns
            states[file, row["start"]] = inside, returns
            inside = row["from_inside"] if inside else row["from_outside"]
    return states


def _cut(batches: Iterator[pa.RecordBatch], states: dict[tuple[str, int], tuple[bool, bool]]) -> Iterator[pa.RecordBatch]:
    """Records of each split; its first piece is a `head` if it begins inside quotes, its last a `tail` if it ends so."""
    for (file, start), runs in groupby(_runs(batches), key=lambda run: run[:2]):
        inside, returns = states[file, start]
        head, first = inside, start == 0
        # The piece that has been begun, line by line, and may go on in the next batch.
        held: list[pa.Array] = []

        def batch_of(records: pa.Array, heads: int, tail: bool):
            nonlocal first
            n = len(records)
            at = np.arange(n)
            out = pa.record_batch(
                [
                    pa.array([file] * n, pa.string()),
                    pa.array([start] * n, pa.int64()),
                    pa.array(at < heads),
                    pa.array(np.full(n, tail)),
                    pa.array((at == 0) & first),
                    records,
                ],
                names=["file", "start", "head", "tail", "first", "record"],
            )
            first = first and n == 0
            return out

        for _, _, lines in runs:
            opens, stays = line_maps(lines)
            ends = inside_after(opens, stays, inside)
            inside = bool(ends[-1])
            if returns:
                lines = pc.replace_substring_regex(lines, "\r$", "")
            closed = np.flatnonzero(~ends)
            if not len(closed):
                held.append(lines)
                continue
            upto = int(closed[-1]) + 1
            whole = pa.concat_arrays([*held, lines[:upto]])
            before = sum(map(len, held))
            bounds = np.concatenate(([0], closed + before + 1)).astype(np.int32)
            records = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), whole), "\n")
            yield batch_of(records, int(head), False)
            head, held = False, [lines[upto:]] if upto < len(lines) else []
        if held:
            left = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, sum(map(len, held))], pa.int32()), pa.concat_arrays(held)), "\n")
            yield batch_of(left, int(head), True)


def _spanning(pieces: DataFrame) -> DataFrame:
    """Records that span splits: a tail, the splits that lie whole inside it, and the head that ends it. At most two pieces a split."""
    order = "PARTITION BY file ORDER BY start, head DESC"
    begins = F.expr(f"sum(int(NOT head)) OVER ({order} ROWS UNBOUNDED PRECEDING)")
    joined = pieces.withColumn("number", begins).groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", F.col("head").alias("goes_on"), "record"))).alias("parts"),
        F.bool_or("first").alias("first"),
    )
    return joined.select("first", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))


def scan_records(spark: SparkSession, path: str) -> DataFrame:
    """`first, record`: the CSV records of all files at `path` as text, and whether it is its file's first one.

    Lines end at a line feed, or, where a file's first line does, at a carriage return and a line feed, which inside fields become a
    line feed. A quote that is never closed takes the rest of its file, without a last line feed. Each file is read twice, the second time as records.
    """
    lines = _lines(ship(spark), path)
    states = split_states(lines)
    sent = spark.sparkContext.broadcast(states)
    pieces = lines.mapInArrow(lambda batches: _cut(batches, sent.value), _PIECE)
    records = pieces.filter("NOT head AND NOT tail").select("first", "record")
    if any(inside for inside, _ in states.values()):
        records = records.unionByName(_spanning(pieces.filter("head OR tail")))
    else:
        # Nothing spans splits, but the last record of a file may be left open.
        records = pieces.select("first", "record")
    return records.filter("record <> ''")
