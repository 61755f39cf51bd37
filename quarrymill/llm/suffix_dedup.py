"""Exact removal of passages that an earlier document has too, by suffix arrays over pieces of text around shared anchors."""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.common import staged
from quarrymill.llm.slabs import kept_slabs, slabs_of, texts_of
from quarrymill.llm.suffix_groups import suffix_arrays


@dataclass(frozen=True)
class Passages:
    """Parameters.

    `least` bytes make a passage. `anchor` bytes, the smallest by hash within a passage, are what equal passages meet by.
    Texts are dealt into slabs of about `slab_bytes`. Suffix arrays are built for buckets of up to `bucket_bytes`
    (fuller ones are cut into single passages first), `lockstep_bytes` at a time. The pieces of an anchor that more than `most_slabs` slabs share
    are dealt into buckets of about `most_slabs` times 64; what stays in them meets again as single passages. None of these bounds what is found.
    """

    least: int = 50
    anchor: int = 20
    slab_bytes: int = 4 << 20
    bucket_bytes: int = 480
    lockstep_bytes: int = 1 << 18
    most_slabs: int = 256
    part_bytes: int = 16 << 20


_RUN = 64  # windows in one piece at most, so that periodic texts make pieces of bounded length
_SLICE = 1 << 17
_LETTERS = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_FACTORS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)]


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the `size` bytes from each place on, by doubling. Equal strings get equal ones; more is not needed."""
    have, h = 1, _LETTERS[data]
    while have < size:
        step = min(have, size - have)
        if len(h) <= step:
            return h[:0]
        h = _mix(h[:-step] * _FACTORS[step < have] + h[step:])
        have += step
    return h


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        if len(h) <= step:
            return h[:0]
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h


def pieces(data: np.ndarray, offsets: np.ndarray, p: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, text, start in `data` and number of windows of every piece, for texts between `offsets`.

    A window is `least` bytes of one text. A piece is a run of consecutive windows whose smallest anchor hash is the same.
    Equal windows have equal smallest anchors, wherever they are, so they are in pieces of one key.
    """
    out: list[tuple[np.ndarray, ...]] = []
    # Long texts are handled in parts that overlap by all but one byte of a window.
    first, last, text = [], [], []
    for t, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        for at in range(low, high - p.least + 1, _SLICE):
            first.append(at)
            last.append(min(at + _SLICE + p.least - 1, high))
            text.append(t)
    at = 0
    while at < len(first):
        upto, total = at, 0
        while upto < len(first) and (upto == at or total + last[upto] - first[upto] <= _SLICE):
            total += last[upto] - first[upto]
            upto += 1
        low, high = np.array(first[at:upto]), np.array(last[at:upto])
        sizes = high - low
        inner = np.concatenate(([0], np.cumsum(sizes)))
        own = np.concatenate([data[a:b] for a, b in zip(low, high)]) if upto - at > 1 else data[low[0] : high[0]]
        v = _sliding_min(hashes(own, p.anchor), p.least - p.anchor + 1)
        owner = np.repeat(np.arange(upto - at), sizes)
        opens = np.ones(len(v), bool)
        opens[1:] = (v[1:] != v[:-1]) | (owner[1 : len(v)] != owner[: len(v) - 1])
        start = np.flatnonzero(opens)
        whole = inner[owner[start] + 1] - start >= p.least
        start = start[whole]
        part = owner[start]
        ends = np.append(start[1:], 0)
        ends = np.where(np.append(part[1:] == part[:-1], False), ends, inner[part + 1] - p.least + 1)
        windows = ends - start
        cuts = (windows + _RUN - 1) // _RUN
        if (cuts > 1).any():
            again = np.repeat(np.arange(len(start)), cuts)
            nth = np.arange(len(again)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start, part = start[again] + nth * _RUN, part[again]
            windows = np.minimum(windows[again] - nth * _RUN, _RUN)
        out.append((v[start], np.array(text[at:upto])[part], start - inner[part] + low[part], windows))
        at = upto
    if not out:
        return np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3
    return tuple(np.concatenate(column) for column in zip(*out))


# --- slabs ------------------------------------------------------------------------------------


def _texts(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, whether each is an id, bytes and offsets of one slab."""
    ids = batch.column("ids")[row].values
    known = np.asarray(ids.is_valid())
    return ids.fill_null(0).to_numpy(zero_copy_only=False), known, *texts_of(batch, row)


# --- shared anchors ---------------------------------------------------------------------------


class _Names:
    """The anchors of one slab, as it names them to others: 32 bits each and a part, with which unlike ones seldom agree.

    `entry` has the entry of each piece, -1 for texts without an id. Entries are ordered by part, those with one piece in the slab before
    those with `many`. `several` are entries of documents with unlike ids, `size` is the logarithm of the number of an entry's pieces.
    An entry that unlike anchors share only costs work.
    """

    def __init__(self, v: np.ndarray, text: np.ndarray, ids: np.ndarray, known: np.ndarray, parts: int):
        fine = np.flatnonzero(known[text])
        low = np.uint64(32)
        name = ((v[fine] >> low) % np.uint64(parts) << low) | (v[fine] & np.uint64(0xFFFFFFFF))
        order = np.argsort(name, kind="stable")
        name, owner = name[order], ids[text[fine[order]]]
        first = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1]))) if len(name) else np.zeros(0, np.int64)
        count = np.diff(np.append(first, len(name)))
        several = np.zeros(0, bool)
        if len(first):
            several = np.minimum.reduceat(owner, first) < np.maximum.reduceat(owner, first)
        part, many = (name[first] >> low).astype(np.int64), count > 1
        by_part = np.lexsort((many, part))
        place = np.empty(len(first), np.int64)
        place[by_part] = np.arange(len(first))
        self.entry = np.full(len(v), -1, np.int64)
        self.entry[fine[order]] = np.repeat(place, count)
        self.part, self.many, self.several = part[by_part], many[by_part], several[by_part]
        self.low = name[first][by_part].astype(np.uint32)
        self.size = np.ceil(np.log2(count[by_part])).astype(np.uint8)


def _blobs(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Binary values of so many of the items each."""
    return _binary(values.view(np.uint8), np.concatenate(([0], np.cumsum(counts))) * values.itemsize)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks)


def _items(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The items of all binary values, one after the other, and how many each value has."""
    array = _one(column)
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1]
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data.view(kind) if data.size else np.zeros(0, kind), np.diff(offsets).astype(np.int64) // np.dtype(kind).itemsize


def _shared(slabs: DataFrame, parts: int, p: Passages) -> DataFrame:
    """slab, part, bits, spread: which of a slab's entries documents with another id have too, in the order of `_Names`.

    Each slab names an anchor once, so a key of a third of all texts is as many entries as there are slabs. `spread` has for each such entry
    the logarithm of the number of buckets its pieces are dealt into; it is empty where that is one for all.
    """

    def named(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, known, data, offsets = _texts(batch, row)
                v, text, _, _ = pieces(data, offsets, p)
                own = _Names(v, text, ids, known, parts)
                if not len(own.part):
                    continue
                numbers, first = np.unique(own.part, return_index=True)
                many = np.add.reduceat(own.many, first, dtype=np.int64)
                once = np.diff(np.append(first, len(own.part))) - many
                yield pa.record_batch(
                    [
                        pa.array(numbers.astype(np.int32)),
                        pa.array([batch.column("slab")[row].as_py()] * len(numbers), pa.int64()),
                        _blobs(own.low[~own.many], once),
                        _blobs(own.low[own.many], many),
                        _blobs(own.size[own.many] | own.several[own.many].astype(np.uint8) << np.uint8(7), many),
                    ],
                    names=["part", "slab", "once", "many", "sizes"],
                )

    def met(table: pa.Table) -> pa.Table:
        once, n_once = _items(table.column("once"), np.uint32)
        many, n_many = _items(table.column("many"), np.uint32)
        sizes, _ = _items(table.column("sizes"), np.uint8)
        entry = np.concatenate((once, many)).astype(np.uint64) << np.uint64(32) | np.arange(len(once) + len(many), dtype=np.uint64)
        entry.sort()
        low, order = entry >> np.uint64(32), (entry & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
        count = np.diff(np.append(first, len(low)))
        of_slab = np.concatenate((np.zeros(len(once), np.uint8), sizes))[order]
        shared = (count > 1) | (np.maximum.reduceat(of_slab, first) >= 128)
        pieces_of = np.add.reduceat(np.left_shift(1, of_slab & np.uint8(127), dtype=np.int64), first)
        wide = np.where(count > p.most_slabs, pieces_of / max(1, p.most_slabs * _RUN), 1)
        spread = np.ceil(np.log2(np.maximum(wide, 1))).astype(np.uint8)
        # Back in the order of the entries: for every slab those with one piece, then the others.
        place = np.empty(len(low), np.int64)
        both = n_once + n_many
        opens = np.cumsum(both) - both
        place[: len(once)] = np.arange(len(once)) + np.repeat(opens - (np.cumsum(n_once) - n_once), n_once)
        place[len(once) :] = np.arange(len(many)) + np.repeat(opens + n_once - (np.cumsum(n_many) - n_many), n_many)
        flags, buckets = np.zeros(len(low), bool), np.zeros(len(low), np.uint8)
        flags[place[order]], buckets[place[order]] = np.repeat(shared, count), np.repeat(spread, count)
        size = (both + 7) // 8
        bits = np.zeros(8 * int(size.sum()), bool)
        bits[np.arange(len(low)) + np.repeat(8 * (np.cumsum(size) - size) - opens, both)] = flags
        row = np.repeat(np.arange(len(both)), both)
        some = np.bincount(row, weights=buckets, minlength=len(both)) > 0
        told = flags & some[row]
        return pa.table(
            {
                "slab": table.column("slab"),
                "part": table.column("part"),
                "bits": _blobs(np.packbits(bits), size),
                "spread": _blobs(buckets[told], np.bincount(row[told], minlength=len(both))),
            }
        )

    keyed = slabs.select("slab", "ids", "texts").mapInArrow(named, "part int, slab long, once binary, many binary, sizes binary")
    return keyed.groupBy("part").applyInArrow(met, "slab long, part int, bits binary, spread binary")


def _told(names: _Names, told: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Of each entry of a slab, whether it is shared, and the logarithm of the number of its buckets."""
    shared, spread = np.zeros(len(names.part), bool), np.zeros(len(names.part), np.uint8)
    for one in told:
        first, last = np.searchsorted(names.part, [one["part"], one["part"] + 1])
        shared[first:last] = np.unpackbits(np.frombuffer(one["bits"], np.uint8))[: last - first]
        if one["spread"]:
            spread[first:last][shared[first:last]] = np.frombuffer(one["spread"], np.uint8)
    return shared, spread


# --- pieces of shared anchors -----------------------------------------------------------------

_OCCURRENCE = np.dtype([("id", "<i8"), ("text", "<i4"), ("start", "<i4")])
_CUT = np.dtype([("text", "<i4"), ("start", "<i4"), ("end", "<i4")])
_PIECE = "v long, spread int, piece binary, least long, slab long, places binary"


def _gathered(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all ranges, one after the other, and their offsets."""
    offsets = np.concatenate(([0], np.cumsum(length)))
    return data[np.arange(offsets[-1]) + np.repeat(start - offsets[:-1], length)], offsets


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(
        pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    )


def _cut_out(batches, parts: int, p: Passages):
    """The distinct pieces of a slab that have shared anchors, each with its places."""
    for batch in batches:
        for row in range(batch.num_rows):
            ids, known, data, offsets = _texts(batch, row)
            v, text, start, windows = pieces(data, offsets, p)
            names = _Names(v, text, ids, known, parts)
            shared, spread = _told(names, batch.column("told")[row].as_py())
            fine = np.flatnonzero(names.entry >= 0)
            fine = fine[shared[names.entry[fine]]]
            if not len(fine):
                continue
            v, text, start, windows, spread = v[fine], text[fine], start[fine], windows[fine], spread[names.entry[fine]]
            strings, bounds = _gathered(data, start, windows + p.least - 1)
            coded = _binary(strings, bounds).dictionary_encode()
            code = coded.indices.to_numpy()
            places = np.empty(len(v), _OCCURRENCE)
            places["id"], places["text"], places["start"] = ids[text], text, start - offsets[text]
            order = np.lexsort((places["id"], code))
            code, places = code[order], places[order]
            first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
            n = len(first)
            yield pa.record_batch(
                [
                    pa.array(v[order][first].view(np.int64)),
                    pa.array(spread[order][first].astype(np.int32)),
                    coded.dictionary.take(pa.array(code[first])),
                    pa.array(places["id"][first]),
                    pa.array([batch.column("slab")[row].as_py()] * n, pa.int64()),
                    _binary(places.view(np.uint8), np.append(first, len(places)) * _OCCURRENCE.itemsize),
                ],
                names=["v", "spread", "piece", "least", "slab", "places"],
            )


# --- suffix arrays ----------------------------------------------------------------------------


def _words_at(flat: np.ndarray, at: np.ndarray, least: int) -> list[np.ndarray]:
    """The `least` bytes from each place on as columns of 64 bits; the last ones overlap."""
    eight = np.lib.stride_tricks.sliding_window_view(flat, 8)
    offsets = [*range(0, least - 7, 8), least - 8] if least >= 8 else []
    if not offsets:
        return [flat[at + k] for k in range(least)]
    return [np.ascontiguousarray(eight[at + k]).view(np.uint64).ravel() for k in dict.fromkeys(offsets)]


def least_of_windows(data: np.ndarray, offsets: np.ndarray, bucket: np.ndarray, least_id: np.ndarray, p: Passages):
    """For each window of each piece, the least id among the equal windows of its bucket.

    Pieces lie in `data` between `offsets`, those of one `bucket` in a row. Returns the values, piece by piece, and the offset of
    each piece's first. A bucket's pieces are one text, parted by a letter below all others; equal windows are neighbours in its suffix
    array. A bucket of one piece has nothing to compare.
    """
    sizes = np.diff(offsets)
    windows = sizes - p.least + 1
    at = np.concatenate(([0], np.cumsum(windows)))
    out = np.repeat(least_id, windows)
    if not len(sizes):
        return out, at
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    count = np.diff(np.append(first, len(bucket)))
    total = np.add.reduceat(sizes, first) + count
    todo = np.flatnonzero(count > 1)
    todo = todo[np.argsort(total[todo], kind="stable")]
    while len(todo):
        fit = np.arange(1, len(todo) + 1) * total[todo] <= max(p.lockstep_bytes, total[todo[0]])
        own, todo = todo[fit], todo[int(fit.sum()) :]
        width = int(total[own[-1]])
        piece, _ = _gathered(np.arange(len(sizes)), first[own], count[own])
        row = np.repeat(np.arange(len(own)), count[own])
        strings, bounds = _gathered(data, offsets[piece], sizes[piece])
        # Letters 2 and up; 1 parts pieces and 0 ends the row.
        run = np.cumsum(sizes[piece] + 1) - (sizes[piece] + 1)
        inner = run - np.repeat(run[np.cumsum(count[own]) - count[own]], count[own])
        begin = row * width + inner
        flat = np.ones(len(own) * width + p.least + 8, np.uint8)
        flat[np.arange(len(strings)) + np.repeat(begin - bounds[:-1], sizes[piece])] = strings + np.uint8(2)
        text = flat[: len(own) * width].reshape(len(own), width)
        text[np.arange(len(own)), total[own] - 1] = 0
        order = suffix_arrays(text, total[own])
        # Windows by place, then in the order of the suffixes.
        n = windows[piece]
        place, _ = _gathered(np.arange(len(flat)), begin, n)
        target, _ = _gathered(np.arange(len(out)), at[piece], n)
        of_place = np.full(len(flat), -1, np.int64)
        of_place[place] = target
        sorted_rows, rank = np.nonzero(order >= 0)
        place = sorted_rows * width + order[sorted_rows, rank]
        place = place[of_place[place] >= 0]
        target = of_place[place]
        same = place[1:] // width == place[:-1] // width
        for word in _words_at(flat, place, p.least):
            same &= word[1:] == word[:-1]
        opens = np.flatnonzero(np.concatenate(([True], ~same)))
        smallest = np.minimum.reduceat(out[target], opens)
        out[target] = np.repeat(smallest, np.diff(np.append(opens, len(target))))
    return out, at


_REMOVAL = "slab long, cuts binary"
_REST = "piece binary, least long, places binary"


def _beaten(table: pa.Table, before: tuple | None) -> tuple[np.ndarray, tuple]:
    """Which rows, sorted by bucket, piece and id, have a row of the same piece and a smaller id before them; (bucket, piece, id) of the last piece."""
    v, least = table.column("v").to_numpy(), table.column("least").to_numpy()
    code = _one(table.column("piece")).dictionary_encode().indices.to_numpy()
    first = np.flatnonzero(np.concatenate(([True], (v[1:] != v[:-1]) | (code[1:] != code[:-1]))))
    smallest = least[first]
    if before and before[0] == v[0] and before[1] == table.column("piece")[0].as_py():
        smallest[0] = before[2]
    last = (v[-1], table.column("piece")[int(first[-1])].as_py(), smallest[-1])
    return least > np.repeat(smallest, np.diff(np.append(first, len(v)))), last


def _cuts_of(slab: np.ndarray, cut: np.ndarray) -> dict[str, pa.Array]:
    order = np.argsort(slab, kind="stable")
    slab, cut = slab[order], cut[order]
    first = np.flatnonzero(np.concatenate(([True], slab[1:] != slab[:-1])))
    return {"slab": pa.array(slab[first]), "cuts": _binary(cut.view(np.uint8), np.append(first, len(cut)) * _CUT.itemsize)}


def _removals(batches, p: Passages, rest: bool):
    """slab, cuts: for the pieces of a bucket in a row, the places whose passages a smaller id has too.

    Of rows with one piece only those of the smallest id are held, until their bucket is whole; all passages of the others go. With `rest`, the
    passages that stay in a bucket that is one of several of its anchor come out, too, as rows of `_REST`.
    """
    kinds = pa.schema([("slab", pa.int64()), ("cuts", pa.binary())])
    if rest:
        kinds = pa.schema([*kinds, ("piece", pa.binary()), ("least", pa.int64()), ("places", pa.binary())])

    def out(columns: dict[str, pa.Array]) -> pa.RecordBatch:
        n = len(columns["slab"])
        return pa.record_batch([columns.get(f.name, pa.nulls(n, f.type)) for f in kinds], schema=kinds)

    def whole(table: pa.Table):
        """Rows of which every passage goes."""
        many, each = _items(table.column("places"), _OCCURRENCE)
        _, size = _items(table.column("piece"), np.uint8)
        cut = np.empty(len(many), _CUT)
        cut["text"], cut["start"], cut["end"] = many["text"], many["start"], many["start"] + np.repeat(size, each)
        return out(_cuts_of(np.repeat(table.column("slab").to_numpy(), each), cut))

    def solve(table: pa.Table):
        v = table.column("v").to_numpy()
        coded = _one(table.column("piece")).dictionary_encode()
        code, strings = coded.indices.to_numpy(), coded.dictionary
        smallest = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(smallest, code, table.column("least").to_numpy())
        key = np.zeros(len(strings), np.int64)
        key[code] = v
        least, at = _in_buckets(strings, key, smallest, p)
        # Occurrences by windows.
        many, each = _items(table.column("places"), _OCCURRENCE)
        of = np.repeat(code, each)
        slab = np.repeat(table.column("slab").to_numpy(), each)
        # A piece's windows that its first occurrence keeps are kept by all if no id is larger.
        n = np.diff(at)[of]
        again = np.repeat(np.arange(len(many)), n)
        nth = np.arange(len(again)) - np.repeat(np.cumsum(n) - n, n)
        gone = least[at[of[again]] + nth] < many["id"][again]
        if rest:
            spread = np.repeat(table.column("spread").to_numpy() > 0, each)
            stays = np.flatnonzero(~gone & spread[again])
            if len(stays):
                own = many[again[stays]]
                own["start"] += nth[stays].astype(np.int32)
                offsets, data = _offsets(strings)
                begin = offsets[of[again[stays]]] + nth[stays]
                yield out(
                    {
                        "slab": pa.array(slab[again[stays]]),
                        "piece": _blobs(_windows(data, begin, p.least), np.ones(len(stays), np.int64) * p.least),
                        "least": pa.array(own["id"]),
                        "places": _blobs(own, np.ones(len(stays), np.int64)),
                    }
                )
        goes = np.flatnonzero(gone)
        if not len(goes):
            return
        again, nth = again[goes], nth[goes]
        opens = np.flatnonzero(np.concatenate(([True], (again[1:] != again[:-1]) | (nth[1:] != nth[:-1] + 1))))
        ends = np.append(opens[1:], len(again)) - 1
        occurrence = again[opens]
        cut = np.empty(len(opens), _CUT)
        cut["text"] = many["text"][occurrence]
        cut["start"] = many["start"][occurrence] + nth[opens]
        cut["end"] = many["start"][occurrence] + nth[ends] + p.least
        yield out(_cuts_of(slab[occurrence], cut))

    held: pa.Table | None = None
    fresh: list[pa.RecordBatch] = []
    last: tuple | None = None

    def ready(end: bool):
        """Cuts of what has come, as far as buckets are whole."""
        nonlocal held, last
        table = pa.Table.from_batches(fresh).combine_chunks()
        fresh.clear()
        gone, last = _beaten(table, last)
        if gone.any():
            yield whole(table.filter(pa.array(gone)))
            table = table.filter(pa.array(~gone))
        table = (pa.concat_tables([held, table]) if held is not None else table).combine_chunks()
        v = table.column("v").to_numpy()
        opens = np.flatnonzero(v[1:] != v[:-1])
        upto = len(v) if end else int(opens[-1]) + 1 if len(opens) else 0
        if upto:
            yield from solve(table.slice(0, upto).combine_chunks())
        held = pa.Table.from_batches(table.slice(upto).combine_chunks().to_batches(), table.schema)

    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        fresh.append(batch)
        size += batch.nbytes
        if size >= 4 * p.lockstep_bytes:
            yield from ready(False)
            size = 0
    if fresh:
        yield from ready(True)
    elif held is not None and held.num_rows:
        yield from solve(held.combine_chunks())


def _solved(found: DataFrame, rest: bool, p: Passages) -> DataFrame:
    """`_removals` of pieces, dealt and sorted by bucket."""
    found = found.repartition(F.col("v")).sortWithinPartitions("v", "piece", "least")
    return found.mapInArrow(lambda batches: _removals(batches, p, rest), f"{_REMOVAL}, {_REST}" if rest else _REMOVAL)


def _offsets(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset : strings.offset + len(strings) + 1].astype(np.int64)
    return offsets, np.frombuffer(strings.buffers()[2], np.uint8)


def _windows(data: np.ndarray, begin: np.ndarray, least: int) -> np.ndarray:
    """The `least` bytes from each place on, one after the other."""
    return np.lib.stride_tricks.sliding_window_view(data, least)[begin].ravel()


def _in_buckets(strings: pa.Array, key: np.ndarray, smallest: np.ndarray, p: Passages):
    """`least_of_windows` of distinct pieces; buckets that are too full are cut into single windows first."""
    offsets, data = _offsets(strings)
    sizes = np.diff(offsets)
    order = np.argsort(key, kind="stable")
    _, first, count = np.unique(key[order], return_index=True, return_counts=True)
    full = np.add.reduceat(sizes[order] + 1, first) > p.bucket_bytes
    full = np.repeat(full & (count > 1), count)
    n = sizes - p.least + 1
    at = np.concatenate(([0], np.cumsum(n)))
    out = np.empty(at[-1], np.int64)
    fits = order[~full]
    strung, bounds = _gathered(data, offsets[fits], sizes[fits])
    values, where = least_of_windows(strung, bounds, key[fits], smallest[fits], p)
    into, _ = _gathered(np.arange(len(out)), at[fits], n[fits])
    out[into] = values
    if full.any():
        wide = order[full]
        begin, _ = _gathered(np.arange(len(data)), offsets[wide], n[wide])
        into, _ = _gathered(np.arange(len(out)), at[wide], n[wide])
        coded = _blobs(_windows(data, begin, p.least), np.full(len(begin), p.least)).dictionary_encode()
        code = coded.indices.to_numpy()
        own = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
        np.minimum.at(own, code, np.repeat(smallest[wide], n[wide]))
        every = coded.dictionary
        strung = np.frombuffer(every.buffers()[2], np.uint8)
        values, _ = least_of_windows(strung, np.arange(len(every) + 1) * p.least, np.arange(len(every)), own, p)
        out[into] = values[code]
    return out, at


# --- results ----------------------------------------------------------------------------------

_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans array<struct<start: long, end: long>>"


def _without(batches, with_texts: bool):
    for batch in batches:
        for row in range(batch.num_rows):
            ids = batch.column("ids")[row].values
            data, offsets = texts_of(batch, row)
            cuts = np.frombuffer(b"".join(batch.column("cuts")[row].as_py() or []), _CUT)
            cuts = cuts[np.lexsort((cuts["start"], cuts["text"]))]
            bounds = np.searchsorted(cuts["text"], np.arange(len(ids) + 1))
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": [], "spans": []}
            for t in range(len(ids)):
                low, high = int(offsets[t]), int(offsets[t + 1])
                own, spans, kept = cuts[bounds[t] : bounds[t + 1]], [], []
                if len(own):
                    reach = np.maximum.accumulate(own["end"])
                    opens = np.flatnonzero(np.concatenate(([True], own["start"][1:] > reach[:-1])))
                    ends = reach[np.append(opens[1:], len(own)) - 1]
                    spans = list(zip(own["start"][opens].tolist(), ends.tolist()))
                done = low
                for start, end in spans:
                    kept.append(data[done : low + start].tobytes())
                    done = low + end
                kept.append(data[done:high].tobytes())
                left = b"".join(kept)
                out["n_bytes"].append(high - low)
                out["n_removed"].append(high - low - len(left))
                out["n_spans"].append(len(spans))
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                out["kept"].append(left if with_texts else None)
                out["spans"].append([{"start": a, "end": b} for a, b in spans] if with_texts else None)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.record_batch(
                [ids, *[pa.array(values, kind) for values, kind in zip(out.values(), kinds)]], names=["doc_id", *out]
            )


def remove_repeated(
    docs: DataFrame, p: Passages = Passages(), *, doc_id: str = "doc_id", text: str = "text", with_texts: bool = True
) -> DataFrame:
    """Each document without the passages that a document with a smaller id has too.

    A passage is `least` bytes of UTF-8 that stand in both texts; matches never cross documents, overlap, and are judged on the
    texts as given. Returns a row per row: `doc_id, n_bytes, n_removed, n_spans, kept_sha256`, and, `with_texts`, the bytes `kept` (which may
    end inside a letter) and the removed `spans`.

    The method: texts are dealt into slabs. Each window of `least` bytes belongs to the smallest hash of its inner anchors, so equal
    windows meet by that key; only keys that two slabs, or two ids of a slab, share go on. Their pieces of text are shuffled by key, each
    distinct piece of a slab once, and in every bucket a suffix array by linear grouping (`suffix_groups`) puts equal windows side by side, compared byte by byte.
    The least id of equal windows goes back to the slabs as cuts. Work is bounded by slab, part and bucket; copies count once a slab,
    and of equal pieces all but those of the least id go through a task as a stream. An anchor with more pieces than a bucket should hold is
    dealt by piece into several; only the windows that none of these removes are shuffled again, by themselves.

    NULL text is empty; texts shorter than a passage lose nothing. Rows without an id lose nothing and take nothing from others, and rows with equal
    ids take nothing from each other, so that repeated rows stay alike. Other columns are left out; an empty table gives none.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = max(1, math.ceil(total / (2 * p.slab_bytes)))
    kept = kept_slabs(slabs_of(rows, p.slab_bytes), min(50_000, buckets))
    # What a bucket of few slabs joins fits into memory, and slabs are not copied to be sorted.
    joined = "shuffle_hash" if buckets <= 50_000 else "merge"
    parts = max(1, math.ceil(total / p.part_bytes))
    shared = staged(_shared(kept, parts, p), "shared-anchors")
    several = not shared.filter(F.octet_length("spread") > 0).isEmpty()
    by_slab = shared.groupBy("slab").agg(F.collect_list(F.struct("part", "bits", "spread")).alias("told"))
    cut = kept.select("slab", "ids", "texts").join(by_slab.hint(joined), "slab").mapInArrow(lambda batches: _cut_out(batches, parts, p), _PIECE)
    dealt = F.when(F.col("spread") == 0, F.col("v")).otherwise(
        F.xxhash64("v", F.pmod(F.xxhash64("piece"), F.expr("shiftleft(1L, spread)")))
    )
    removals = staged(_solved(cut.withColumn("v", dealt), several, p), "removals")
    if several:
        rest = removals.filter(F.col("piece").isNotNull())
        rest = rest.select(F.xxhash64("piece").alias("v"), F.lit(0).alias("spread"), "piece", "least", "slab", "places")
        last = staged(_solved(rest, False, p), "last-removals")
        removals = removals.filter(F.col("cuts").isNotNull()).select("slab", "cuts").unionByName(last)
    removals = removals.groupBy("slab").agg(F.collect_list("cuts").alias("cuts"))
    whole = kept.select("slab", "ids", "texts").join(removals.hint(joined), "slab", "left")
    out = whole.mapInArrow(lambda batches: _without(batches, with_texts), _RESULT)
    return out if with_texts else out.drop("kept", "spans")
