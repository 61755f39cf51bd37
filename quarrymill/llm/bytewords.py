"""Words of whole Arrow batches as 64-bit hashes, found on the bytes with numpy, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes handled at a time; one longer text is handled alone.
SLICE_BYTES = 1 << 18

_GOLDEN, _ALL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (the finisher of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lowered() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


_LOWERED = _lowered()
# Every byte but blanks is part of a word.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
# ASCII letters and digits and all bytes beyond ASCII are part of a word.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Words:
    """The words of some texts: `hashes` of lower-cased words and `bounds`, where each text's words begin and end.

    `stems` has the hashes of the words' first bytes, for each number of bytes that was asked for.
    """

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, stems: list[np.ndarray]):
        self.hashes, self.bounds, self.stems = hashes, bounds, stems

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def grams(self, size: int, skip: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of `size` words in a row (or of two with `skip` words between), and the text of each."""
        offsets = (0, 1 + skip) if skip else range(size)
        n = len(self.hashes) - offsets[-1]
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        total = np.full(n, np.uint64(size + 977 * skip))
        for offset in offsets:
            total = mix(total + self.hashes[offset : offset + n])
        owner = self.owner()
        within = owner[:n] == owner[offsets[-1] :]
        return total[within], owner[:n][within]


def words_of(data: np.ndarray, offsets: np.ndarray, of_word: np.ndarray, stems: tuple[int, ...] = ()) -> Words:
    """Words of the texts that lie in `data` between `offsets`."""
    offsets = offsets.astype(np.int64)
    base, n = offsets[0], int(offsets[-1] - offsets[0])
    offsets = offsets - base
    data = data[base : base + n]
    if n == 0:
        return Words(np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), [np.zeros(0, np.uint64) for _ in stems])
    inside = of_word[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]  # a text's first byte begins a word, its last one ends it
    starts[firsts] = inside[firsts]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[lasts] = inside[lasts]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    lowered = np.zeros(n + 8, np.uint8)
    lowered[:n] = _LOWERED[data]
    eight = np.lib.stride_tricks.sliding_window_view(lowered, 8)

    def hashed(last: np.ndarray) -> np.ndarray:
        """A word's hash sums its scrambled groups of eight bytes, each with its place, so that no order or repetition cancels out."""
        size = last - start + 1
        groups = (size + 7) >> 3
        word = np.repeat(np.arange(len(start)), groups)
        place = np.arange(len(word)) - np.repeat(np.cumsum(groups) - groups, groups)
        at = start[word] + 8 * place
        value = np.ascontiguousarray(eight[at]).view("<u8").ravel()
        left = np.minimum(size[word] - 8 * place, 8).astype(np.uint64)
        value = value & (_ALL >> (np.uint64(64) - np.uint64(8) * left))
        terms = mix(mix(value + _GOLDEN) + (place.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
        total = np.add.reduceat(terms, np.cumsum(groups) - groups) if len(terms) else np.zeros(0, np.uint64)
        return mix(total + size.astype(np.uint64))

    cut = [hashed(np.minimum(end, start + size - 1)) for size in stems]
    return Words(hashed(end), np.searchsorted(start, offsets), cut)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values. NULL is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if offsets is None or len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def slices(
    texts: pa.Array, of_word: np.ndarray, stems: tuple[int, ...] = ()
) -> Iterator[tuple[int, int, Words]]:
    """(first, last, words) of consecutive rows of a string column, a slice of bytes at a time."""
    data, offsets = buffers(texts)
    first, n = 0, len(texts)
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, words_of(data, offsets[first : last + 1], of_word, stems)
        first = last


def sums_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of the values of each."""
    if len(keys) == 0:
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(values, first)
