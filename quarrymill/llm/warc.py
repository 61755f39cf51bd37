"""WARC archives written and read by Spark, with boundary-chain verification of records."""

from __future__ import annotations

import hashlib
from base64 import b32encode

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import bounded, staged

# The format's marks.
MAGIC = "WARC/1.1\r\n"
HEAD_END = "\r\n\r\n"
RECORD_END = "\r\n\r\n"
_BASE32_DIGITS, _BASE32 = "0123456789abcdefghijklmnopqrstuv", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1, as archives write digests: five hex digits are four of base 32."""
    hexed = F.sha1(payload)
    parts = [
        F.lpad(F.lower(F.conv(F.substring(hexed, 1 + 5 * k, 5), 16, 32)), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*parts), _BASE32_DIGITS, _BASE32)


def with_revisits(pages: DataFrame, payload: str, page_id: str, least_bytes: int) -> DataFrame:
    """`pages` with `digest` and `keeper`: the page whose response stands for this payload, NULL where it is its own.

    Of equal payloads of at least `least_bytes` bytes the largest id is the response; rows that repeat that id with
    that payload are responses too.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    given = pages.withColumn("digest", sha1_base32(body))
    # Only payloads that occur again need a keeper; the pages themselves are then shuffled only if those are very many.
    again = given.groupBy("digest").agg(F.max(page_id).alias("largest"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    joined = given.join(bounded(staged(again.drop("n"), "again")), "digest", "left")
    large = F.octet_length(F.coalesce(F.col(payload), F.lit(""))) >= least_bytes
    other = F.col("largest").isNotNull() & ~F.col(page_id).eqNullSafe(F.col("largest"))
    return joined.withColumn("keeper", F.when(large & other, F.col("largest"))).drop("largest")


def records(pages: DataFrame, payload: str, page_id: str, url: str) -> Column:
    """The text of a record without its last line ends, from the columns of `with_revisits`."""
    body = F.coalesce(F.col(payload), F.lit(""))
    revisit = F.col("keeper").isNotNull()

    def line(name: str, value: Column) -> Column:
        # NULL values have no line; line ends in a value would end the head.
        return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]+", " "), F.lit("\r\n")), F.lit(""))

    sent = F.when(revisit, F.lit("")).otherwise(body)
    return F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Target-URI", F.col(url)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Page-Id", F.col(page_id).cast("string")),
        line("X-Payload-Length", F.octet_length(body).cast("string")),
        line("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("urn:page:"), F.col("keeper").cast("string")))),
        line("Content-Length", F.octet_length(sent).cast("string")),
        F.lit("\r\n"),
        sent,
    )


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    payload: str = "html",
    page_id: str = "page_id",
    url: str = "url",
    least_bytes: int = 0,
) -> None:
    """Write one record per row of `pages` into WARC files under `path`, one file per task, through Spark's writer.

    Payloads are UTF-8, NULL is empty. A NULL id or URL has no line in its record.
    """
    marked = with_revisits(pages.select(payload, page_id, url), payload, page_id, least_bytes)
    text = marked.select(records(marked, payload, page_id, url).alias("value"))
    text.write.option("lineSep", RECORD_END).text(path)


class _Head:
    """What a record's head says; `length` is that of the whole record, None if the head is not complete."""

    def __init__(self, piece: bytes):
        end = piece.find(HEAD_END.encode())
        self.fields = {}
        for line in piece[: max(end, 0)].split(b"\r\n"):
            name, colon, value = line.partition(b": ")
            if colon:
                self.fields[name.lower()] = value.decode("utf-8", "replace")
        size = self.fields.get(b"content-length", "")
        self.size = int(size) if size.isascii() and size.isdigit() and len(size) < 16 else -1
        self.head = end + len(HEAD_END)
        ok = end >= 0 and self.size >= 0
        self.length = len(MAGIC) + self.head + self.size + len(RECORD_END) if ok else None


_CANDIDATE = (
    "file string, block long, at long, next long, leave long, bytes long, page_id long, kind string, "
    "head_digest string, head_length long, refers_to long, head long, size long, digest string"
)
_ARROW = pa.schema(
    [(p.split()[0], {"string": pa.string(), "long": pa.int64()}[p.split()[1]]) for p in _CANDIDATE.split(", ")]
)


def _number(text: str | None) -> int | None:
    digits = (text or "").removeprefix("-")
    if not (digits.isascii() and digits.isdigit() and len(digits) < 20):
        return None
    return number if -(2**63) <= (number := int(text)) < 2**63 else None


def _located(batches):
    """(file, block, at, piece) of each piece between magics; `at` counts bytes from the block's first piece."""
    where, at = None, 0
    for batch in batches:
        for file, block, piece in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if (file, block) != where:
                where, at = (file, block), 0
            yield file, block, at, piece
            at += len(piece) + len(MAGIC)


def _flushed(rows: list[list]) -> pa.RecordBatch:
    """The candidates of one block, each with the first place outside to which its chain leads.

    A place inside the block that is no candidate breaks a chain.
    """
    end = rows[-1][2] + rows[-1][5]
    leave: dict[int, int | None] = {}
    for row in reversed(rows):
        after = row[3]
        row[4] = leave[row[2]] = after if after is None or after >= end else leave.get(after)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def _candidates(batches):
    """A row for each piece that might be a record: its place, its successor's, and what its head says.

    A piece that its own record fills is digested here. Nothing but heads is held, for one block at a time.
    """
    rows: list[list] = []
    for file, block, at, piece in _located(batches):
        if rows and rows[-1][:2] != [file, block]:
            yield _flushed(rows)
            rows = []
        head = _Head(piece)
        f = head.fields
        whole = head.length is not None and head.length == len(MAGIC) + len(piece)
        payload = piece[head.head : head.head + head.size] if whole else b""
        rows.append(
            [
                file, block, at, None if head.length is None else at + head.length, None, len(piece) + len(MAGIC),
                _number(f.get(b"x-page-id")), f.get(b"warc-type"), f.get(b"warc-payload-digest", "").removeprefix("sha1:"),
                _number(f.get(b"x-payload-length")), _number(f.get(b"warc-refers-to", "").rpartition(":")[2]),
                head.head, head.size, b32encode(hashlib.sha1(payload).digest()).decode() if whole else None,
            ]
        )
    if rows:
        yield _flushed(rows)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, value: what stands between magics, read in splits. The first piece of a file is empty."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def _entries(placed: DataFrame, most_blocks: int) -> DataFrame:
    """file, place: where each file's chain of records enters its blocks, by pointer jumping from the file's start."""
    start = F.col("place") == len(MAGIC)
    targets = placed.filter("leave IS NOT NULL").select("file", F.col("leave").alias("place")).distinct()
    starts = placed.filter(start).select("file", "place")
    hops = placed.join(targets.unionByName(starts).distinct(), ["file", "place"], "left_semi")
    hops = staged(hops.filter("leave IS NOT NULL").select("file", "place", "leave"), "hops")
    reached = starts
    for _ in range(most_blocks.bit_length()):
        further = reached.join(hops, ["file", "place"]).select("file", F.col("leave").alias("place"))
        reached = staged(reached.unionByName(further).distinct(), "reached")
        second = hops.select("file", F.col("place").alias("leave"), F.col("leave").alias("beyond"))
        hops = staged(
            hops.join(second, ["file", "leave"]).select("file", "place", F.col("beyond").alias("leave")), "hops"
        )
    return reached


def _marked(frame):
    """`frame`, one block's candidates, with those marked that the chain from the block's entry meets."""
    frame = frame.sort_values("at")
    successor = dict(zip(frame["at"], frame["next"]))
    on_chain = set()
    for at in frame["at"][frame["entry"].to_numpy(bool)]:
        while at in successor and at not in on_chain:
            on_chain.add(at)
            at = successor[at]
    frame["entry"] = frame["at"].isin(on_chain)
    return frame


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the WARC files under `path`, with payload digests taken from what was read.

    The method: files are read in splits and cut at every magic, also at those inside payloads. Tasks emit each
    candidate's place and that of its successor, by the length in its head. Within a block the tasks follow
    chains themselves, so that a candidate has one hop out of its block; pointer jumping over these hops, doubling
    its reach each round, finds from the file's start where the chain enters each block; a last look inside the
    blocks marks the records on it. Whatever else looks like a record is part of a payload. Only records
    with such parts are read a second time and put together.

    Returns `page_id, record_type, payload_bytes, payload_digest, refers_to, intact`. A revisit has the length and
    digest its head names; a response has those of its payload as read, and `intact` says whether its head agrees.
    """
    found = staged(_pieces(spark, path).mapInArrow(_candidates, _CANDIDATE), "candidates")
    blocks = found.groupBy("file", "block").agg(F.sum("bytes").alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = staged(blocks.withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0))), "blocks")
    most = blocks.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    placed = found.join(blocks.select("file", "block", "base"), ["file", "block"]).select(
        "file", "block", "at", "next", "base", (F.col("base") + F.col("at")).alias("place"),
        (F.col("base") + F.col("leave")).alias("leave"),
    )
    placed = staged(placed, "placed")
    entries = _entries(placed, most).withColumn("entry", F.lit(True))
    shape = "file string, block long, at long, next double, place long, entry boolean"
    marked = (
        placed.join(entries, ["file", "place"], "left")
        .select("file", "block", "at", F.col("next").cast("double").alias("next"), "place",
                F.coalesce("entry", F.lit(False)).alias("entry"))
        .groupBy("file", "block")
        .applyInPandas(_marked, shape)
        .select("file", "block", "at", "place", F.col("entry").alias("on_chain"))
    )
    marked = staged(found.join(marked, ["file", "block", "at"]), "marked")

    records = marked.filter("on_chain")
    response = F.col("kind") == "response"
    own = records.select(
        "page_id",
        F.col("kind").alias("record_type"),
        F.when(response, F.col("size")).otherwise(F.col("head_length")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.col("head_digest")).alias("payload_digest"),
        "refers_to",
        "head_digest",
        "digest",
    )
    torn = records.filter("digest IS NULL")
    whole = own.filter("digest IS NOT NULL").drop("digest")
    if not torn.isEmpty():
        whole = whole.unionByName(_put_together(spark, path, marked))
    return whole.withColumn("intact", F.col("payload_digest") == F.col("head_digest")).drop("head_digest")


def _put_together(spark: SparkSession, path: str, marked: DataFrame) -> DataFrame:
    """Records whose payload holds magics, from a second reading of their pieces."""
    before = Window.partitionBy("file").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    torn = marked.filter("NOT on_chain OR digest IS NULL")
    owned = torn.withColumn("owner", F.max(F.when(F.col("on_chain"), F.col("place"))).over(before))
    owned = staged(owned.filter("owner IS NOT NULL").select("file", "block", "at", "place", "owner"), "owned")

    def located(batches):
        rows = []
        for row in _located(batches):
            rows.append(row)
            if len(rows) >= 500:
                yield _as_batch(rows)
                rows = []
        if rows:
            yield _as_batch(rows)

    pieces = _pieces(spark, path).mapInArrow(located, "file string, block long, at long, piece binary")
    parts = pieces.join(owned, ["file", "block", "at"]).groupBy("file", "owner").agg(
        F.sort_array(F.collect_list(F.struct("place", F.col("piece").cast("string").alias("piece")))).alias("parts")
    )
    heads = marked.filter("on_chain AND digest IS NULL").withColumnRenamed("place", "owner")
    joined = heads.join(parts, ["file", "owner"])
    text = F.array_join(F.col("parts.piece"), MAGIC).cast("binary")
    payload = F.expr("substring(body, int(head) + 1, int(size))")
    return joined.withColumn("body", text).select(
        "page_id",
        F.col("kind").alias("record_type"),
        F.col("size").alias("payload_bytes"),
        sha1_base32(payload).alias("payload_digest"),
        "refers_to",
        "head_digest",
    )


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(arrays, names=["file", "block", "at", "piece"])
