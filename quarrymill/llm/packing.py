"""Packing: tokenised documents into sequences of one length, balanced by estimated attention cost."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path
from struct import Struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import staged

SEQUENCE_TOKENS = 2048
END_ID = 1
# Short pieces packed together by one task: at most so many times a sequence's ids in memory.
PIECES_PER_GROUP = 4000
# Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n, in units of one token's feed-forward work.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096

# The splitting pattern of the tokenizer file for texts of these characters, in lower case.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
# Letters and digits are tried first; no part that begins with an apostrophe begins with one of them.
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-z0-9ß-öø-ÿ]+")
# All of these but runs of letters, for Arrow, which sets them apart by blanks.
_APART = r"([0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sa-zß-öø-ÿ0-9]+)"
# The same pattern in full, as the tokenizer file must state it for the short way to be taken.
_STATED = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Parts whose ids are kept, and as many again that were in use before them.
_MOST_CACHED, _LONGEST_CACHED = 50_000, 64
# Plain texts are split together up to so many letters; Arrow's copies of them are all given back after each batch.
_TOGETHER = 1 << 20


def _byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for each byte: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + k) for k, b in enumerate(rest)}}


class _Ids(dict):
    """The ids of a part of a text as bytes, worked out when first asked for and kept while in use.

    When `_MOST_CACHED` are kept, they become `before`; those asked for again come back from there, the others go the next time.
    """

    def __init__(self, encode):
        super().__init__()
        self.encode, self.before = encode, {}

    def __missing__(self, part: str) -> bytes:
        ids = self.before.get(part)
        if ids is None:
            ids = _as_bytes(self.encode(part))
        if len(part) > _LONGEST_CACHED:
            return ids
        if len(self) >= _MOST_CACHED:
            self.before = dict(self)
            self.clear()
        self[part] = ids
        return ids


# How as many numbers as a word commonly has are written.
_WRITTEN = [Struct(f"<{n}I").pack for n in range(17)]


def _as_bytes(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return _WRITTEN[len(ids)](*ids) if len(ids) < len(_WRITTEN) else np.asarray(ids, "<u4").tobytes()


class Encoder:
    """A tokenizer's ids for whole texts, the same as its own `encode`, with repeated words looked up."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        # Asked of the tokenizer, so that its file with all words is not parsed a second time.
        stated = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer else None
        self.by_words = _STATED in json.dumps(stated, ensure_ascii=False).replace("\\\\", "\\")
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        letters = _byte_letters()
        tokens = self.tokenizer.model.tokenize

        def word(part: str) -> list[int]:
            # Printable ASCII stands for itself.
            written = part if part.isascii() else part.encode().decode("latin-1").translate(letters)
            return [t.id for t in tokens(written)]

        self.words = _Ids(word)
        self.chunks = _Ids(self.whole)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def __call__(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return self.all([text])[0]

    def all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text. Plain ones are split side by side by Arrow, so that a part is looked up once for all of them."""
        out, plain, size = [b""] * len(texts), [[]], 0
        for k, text in enumerate(texts):
            if not self.by_words or any(s in text for s in self.special):
                out[k] = _as_bytes(self.whole(text))
            elif _PLAIN.fullmatch(text):
                if size > _TOGETHER:
                    plain.append([])
                    size = 0
                plain[-1].append(k)
                size += len(text)
            else:
                # White space is dropped and nothing reaches across it, so the text may be cut there.
                out[k] = b"".join(map(self._chunk, text.replace("\n", " ").split(" ")))
        for some in filter(None, plain):
            for k, ids in zip(some, self._plain([texts[k].lower() for k in some])):
                out[k] = ids
        return out

    def _plain(self, lowered: list[str]) -> Iterator[bytes]:
        spaced = pc.replace_substring_regex(pa.array(lowered, pa.large_string()), _APART, r" \1 ")
        split = pc.ascii_split_whitespace(spaced)
        parts = split.values.dictionary_encode()
        # By way of numpy, which makes the strings without an Arrow scalar for each.
        distinct = parts.dictionary.to_numpy(zero_copy_only=False).tolist()
        words = self.words
        ids = pa.array([words[part] if part else b"" for part in distinct], pa.large_binary())
        del distinct
        joined = ids.take(parts.indices)
        _, offsets, data = joined.buffers()
        bounds = np.frombuffer(offsets, np.int64)[: len(joined) + 1][split.offsets.to_numpy()].tolist()
        data = memoryview(data) if data is not None else b""
        return (bytes(data[low:high]) for low, high in zip(bounds, bounds[1:]))

    def _chunk(self, chunk: str) -> bytes:
        if _PLAIN.fullmatch(chunk):
            return b"".join(map(self.words.__getitem__, _PARTS.findall(chunk.lower())))
        return self.chunks[chunk]


_encoders: dict[int, Encoder] = {}


def _encoder(tokenizer_json: str) -> Encoder:
    """One encoder for a worker, so that words stay known from task to task."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer_json)
    return _encoders[key]


def tokenize(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """row, doc, doc_tokens, start, length, ids: documents cut into pieces of `most` tokens and a shorter last one.

    `ids` holds little-endian unsigned 32-bit numbers. Every document ends in `end_id`, so a NULL or empty text
    is a piece of one token. The tokenizer file is read by the driver and sent along (a few MB).
    """
    source = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    width = 4 * most
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches):
        encode = _encoder(source.value)
        for batch in batches:
            rows, ids = batch.column("row").to_pylist(), batch.column("doc").to_pylist()
            out = []
            for row, doc, data in zip(rows, ids, encode.all(batch.column("text").fill_null("").to_pylist())):
                data += end
                n = len(data) // 4
                for at in range(0, len(data), width):
                    piece = data[at : at + width]
                    out.append((row, doc, n, at // 4, len(piece) // 4, piece))
                    if len(out) >= 2000:
                        yield _batch(out)
                        out = []
            if out:
                yield _batch(out)
            pa.default_memory_pool().release_unused()

    given = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc"), F.col(text).alias("text")
    )
    return given.mapInArrow(cut, "row long, doc long, doc_tokens long, start long, length long, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    *numbers, ids = zip(*rows)
    arrays = [pa.array(x, pa.int64()) for x in numbers] + [pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=["row", "doc", "doc_tokens", "start", "length", "ids"])


def place(lengths: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(piece, from, length, sequence, offset): pieces assigned to as few sequences as can hold them all.

    Pieces go in descending order, each to the sequence of lowest cost that still has room for it. What finds no
    room in one sequence is cut and goes to those with most room left. Ties go to the smaller index.
    """
    bins = max(1, -(-int(lengths.sum()) // capacity))
    room = np.full(bins, capacity)
    cost = np.zeros(bins)
    out, late = [], []

    def put(piece: int, start: int, n: int, at: int) -> None:
        out.append((piece, start, n, at, int(capacity - room[at])))
        room[at] -= n
        cost[at] += LINEAR * n + QUADRATIC * n * n

    for piece in np.argsort(-lengths, kind="stable"):
        n = int(lengths[piece])
        at = int(np.argmin(np.where(room >= n, cost, np.inf)))
        if room[at] >= n:
            put(int(piece), 0, n, at)
        else:
            late.append(int(piece))
    for piece in late:
        start, n = 0, int(lengths[piece])
        while start < n:
            at = int(np.argmax(room))
            step = min(n - start, int(room[at]))
            put(piece, start, step, at)
            start += step
    return out


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    most: int = SEQUENCE_TOKENS,
    end_id: int = END_ID,
    pieces_per_group: int = PIECES_PER_GROUP,
) -> DataFrame:
    """Pack all documents into sequences of at most `most` tokens.

    The method: a document's full pieces of `most` tokens are sequences by themselves. The shorter pieces are dealt
    at random (by a hash) to groups of about `pieces_per_group`, the groups of which are packed side by side: in
    descending order, each piece to the sequence of lowest estimated cost, linear plus quadratic in the
    lengths of its pieces, that has the room. A group has the fewest sequences that hold its tokens, so less than one
    sequence of a group is padding; a piece without room is cut.

    Returns `doc_id, doc_tokens, start, length, ids, sequence_id, offset`, one row per piece. Full sequences
    have even ids, packed ones odd ids. Rows that repeat an id are documents of their own. An empty table gives
    no rows.
    """
    pieces = staged(
        tokenize(docs, tokenizer, doc_id=doc_id, text=text, most=most, end_id=end_id), "pieces"
    )
    short = pieces.filter(F.col("length") < most)
    groups = max(1, -(-short.count() // pieces_per_group))

    def packed(key, table):
        table = table.sort_by([("row", "ascending"), ("start", "ascending")])
        moves = place(table.column("length").to_numpy(), most)
        piece = np.array([m[0] for m in moves], np.int64)
        skip, length, at, offset = (np.array([m[k] for m in moves], np.int64) for k in range(1, 5))
        taken = table.take(pa.array(piece))
        ids = pa.concat_arrays(taken.column("ids").chunks)
        parted = np.flatnonzero(length < taken.column("length").to_numpy())
        if len(parted):
            cuts = [ids[k].as_py()[4 * skip[k] : 4 * (skip[k] + length[k])] for k in parted.tolist()]
            where = np.zeros(len(ids), bool)
            where[parted] = True
            ids = pc.replace_with_mask(ids, pa.array(where), pa.array(cuts, ids.type))
        pa.default_memory_pool().release_unused()
        return pa.table(
            {
                "doc": taken.column("doc"),
                "doc_tokens": taken.column("doc_tokens"),
                "start": pa.array(taken.column("start").to_numpy() + skip),
                "length": pa.array(length),
                "ids": ids,
                "sequence_id": pa.array(((key[0].as_py() << 32) + at) * 2 + 1),
                "offset": pa.array(offset),
            }
        )

    schema = "doc long, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long"
    group = F.pmod(F.xxhash64("row"), F.lit(groups))
    tails = short.withColumn("group", group).groupBy("group").applyInArrow(packed, schema)
    full = pieces.filter(F.col("length") == most).select(
        "doc", "doc_tokens", "start", "length", "ids",
        (F.monotonically_increasing_id() * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    return full.unionByName(tails).withColumnRenamed("doc", doc_id)
