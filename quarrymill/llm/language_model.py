"""Language-model scoring: a weighted backoff automaton over all n-grams counted in the corpus."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.llm.bytewords import NOT_BLANK, mix, slices
from quarrymill.llm.common import staged
from quarrymill.llm.slabs import kept_slabs, slabs_of

# The token after the last word of a text.
END = np.uint64(0x3C2F733E)


@dataclass(frozen=True)
class Parameters:
    """`prior` is how many occurrences a history lends to what the shorter one predicts.

    Texts are walked `segment` tokens at a time, many side by side. `slab_bytes` of text are counted and walked together, and a task adds up counts of
    some `part_keys` n-grams. `spare_bits` make the hashes of n-grams longer than their number needs, so that one in
    2**spare_bits look-ups may meet an unlike n-gram. The model holds every n-gram of up to three words of the training texts.
    """

    prior: float = 30.0
    segment: int = 256
    slab_bytes: int = 8 << 20
    part_keys: int = 2_000_000
    spare_bits: int = 24

    def bits(self, size: int) -> int:
        """How many bits tell apart the n-grams of `size` bytes of text."""
        return min(64, max(52, (3 * size // 2).bit_length() + self.spare_bits))


# --- n-grams of a slab ------------------------------------------------------------------------


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two, in this order."""
    return mix(mix(a + np.uint64(0x9E3779B97F4A7C15)) + b)


def ordered(keys: np.ndarray) -> np.ndarray:
    """The places of the keys in ascending order, those of equal keys in any order.

    The keys' highest bits are sorted with their places below them, several times faster than places by keys. Where keys of which
    only lower bits differ come out of order, rare among hashes, all are sorted in full.
    """
    key_bits, place_bits = int(keys.max(initial=0)).bit_length(), max(1, len(keys).bit_length())
    packed = keys >> np.uint64(max(0, key_bits + place_bits - 64))
    packed <<= np.uint64(place_bits)
    packed |= np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    packed &= np.uint64((1 << place_bits) - 1)
    order = packed.astype(np.int32 if len(keys) < 2**31 else np.int64)
    del packed
    if key_bits + place_bits > 64:
        inside = keys[order]
        if (inside[1:] < inside[:-1]).any():
            return np.argsort(keys).astype(order.dtype)
    return order


def ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys, ascending; which of them each key is; a place of each."""
    order = ordered(keys)
    inside = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = inside[1:] != inside[:-1]
    at = np.empty(len(keys), order.dtype)
    at[order] = np.cumsum(new, dtype=order.dtype) - 1
    return inside[new], at, order[new]


class Grams:
    """Tokens of some texts and their n-grams of `sizes` words.

    `keys[n]` are the distinct hashes of n + 1 words, ascending. `at[n]` says for every token which of them ends there, -1 where the text has
    too few words before it, and `found[n]` for every key a token where it ends. For other sizes they are None.
    """

    def __init__(self, texts: pa.Array, bits: int = 64, sizes: tuple[int, ...] = (1, 2, 3)):
        tokens, lengths = [], []
        for _, _, words in slices(texts, NOT_BLANK):
            tokens.append(np.insert(words.hashes, words.bounds[1:], END))
            lengths.append(np.diff(words.bounds) + 1)
        self.tokens = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
        del tokens
        self.bounds = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths]))
        self.keys, self.at, self.found = [None] * 3, [None] * 3, [None] * 3
        cut = np.uint64(64 - bits)
        key, whole = self.tokens, np.ones(len(self.tokens), bool)
        for n in range(max(sizes)):
            if n:
                key = np.concatenate((np.zeros(1, np.uint64), _paired(key[:-1], self.tokens[1:])))[: len(key)]
                first = self.bounds[:-1] + n - 1
                whole[first[first < self.bounds[1:]]] = False
            if n + 1 in sizes:
                places = np.flatnonzero(whole)
                self.keys[n], at, found = ranked(key[places] >> cut if n else key)
                self.at[n] = np.full(len(key), -1, at.dtype)
                self.at[n][places] = at
                self.found[n] = places[found].astype(at.dtype)


# --- counts -----------------------------------------------------------------------------------


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending numbers as their differences, byte by byte: the highest bytes, which are mostly small, are compressed."""
    if not len(keys):
        return b""
    gaps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(gaps[1:].max(initial=0)).bit_length() + 7) // 8)
    raw = np.ascontiguousarray(gaps.astype("<u8")).view(np.uint8).reshape(-1, 8)
    raw[0] = 0
    high = zlib.compress(np.ascontiguousarray(raw[:, width - 1]).tobytes(), 1)
    head = bytes([width]) + int(keys[0]).to_bytes(8, "little") + len(high).to_bytes(4, "little")
    return head + high + np.ascontiguousarray(raw[:, : width - 1].T).tobytes()


def unpack_sorted(blob: bytes) -> np.ndarray:
    if not blob:
        return np.zeros(0, np.uint64)
    width, first, size = blob[0], int.from_bytes(blob[1:9], "little"), int.from_bytes(blob[9:13], "little")
    high = np.frombuffer(zlib.decompress(blob[13 : 13 + size]), np.uint8)
    out = np.zeros((len(high), 8), np.uint8)
    out[:, width - 1] = high
    out[:, : width - 1] = np.frombuffer(blob[13 + size :], np.uint8).reshape(width - 1, len(high)).T
    gaps = out.view("<u8").ravel()
    gaps[0] = first
    return np.cumsum(gaps, dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if int(counts.max(initial=0)) <= np.iinfo(k).max)
    return kind[1:].encode() + zlib.compress(counts.astype(kind).tobytes(), 1)


def unpack_counts(blob: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(blob[2:]), "<" + blob[:2].decode()).astype(np.int64)


def _taught(batch: pa.RecordBatch, row: int, grams: Grams) -> np.ndarray:
    """Whether each token is in a training text."""
    taught = np.asarray(batch.column("taughts")[row].values.fill_null(False))
    return np.repeat(taught, np.diff(grams.bounds))


def _own(grams: Grams, n: int, taught: np.ndarray) -> np.ndarray:
    """How often the slab's own training texts have its n-grams of n + 1 words."""
    at = grams.at[n]
    return np.bincount(at[(at >= 0) & taught], minlength=len(grams.keys[n]))


def _counts_of(found, n: int) -> np.ndarray:
    """The corpus's counts of a slab's n-grams, in the order of their keys, from what has come back."""
    parts = sorted((r["part"], r["counts"]) for r in found or () if r["size"] == n + 1)
    return np.concatenate([unpack_counts(blob) for _, blob in parts] or [np.zeros(0, np.int64)])


def _asked(grams: Grams, taught: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which n-grams of three words other slabs may have: those whose pairs other training texts have too."""
    elsewhere = two > _own(grams, 1, taught)
    last = grams.found[2]
    return elsewhere[grams.at[1][last]] & elsewhere[grams.at[1][last - 1]]


def _named(batches: Iterator[pa.RecordBatch], parts: int, bits: int, sizes: tuple[int, ...]):
    """size, part, slab, keys, counts: n-grams of each slab by ranges of their keys, and how often its training texts have them.

    Of three words those that are `_asked` for, once the counts of the shorter ones have come back.
    """
    for batch in batches:
        for row in range(batch.num_rows):
            yield _ranges(batch, row, parts, bits, sizes)


def _ranges(batch: pa.RecordBatch, row: int, parts: int, bits: int, sizes: tuple[int, ...]) -> pa.RecordBatch:
    """What `_named` says of one slab."""
    grams = Grams(batch.column("texts")[row].values, bits, (2, 3) if 3 in sizes else sizes)
    taught = _taught(batch, row, grams)
    out: dict[str, list] = {"size": [], "part": [], "keys": [], "counts": []}
    for size in sizes:
        keys, counts = grams.keys[size - 1], _own(grams, size - 1, taught)
        if size == 3:
            asked = _asked(grams, taught, _counts_of(batch.column("found")[row].as_py(), 1))
            keys, counts = keys[asked], counts[asked]
        width = -(-(1 << (64 if size == 1 else bits)) // parts)
        cuts = [*np.searchsorted(keys, np.array([k * width for k in range(parts)], np.uint64)).tolist(), len(keys)]
        for part, (low, high) in enumerate(zip(cuts, cuts[1:])):
            if low < high:
                out["size"].append(size)
                out["part"].append(part)
                out["keys"].append(pack_sorted(keys[low:high]))
                out["counts"].append(pack_counts(counts[low:high]))
    return pa.record_batch(
        [
            pa.array(out["size"], pa.int32()),
            pa.array(out["part"], pa.int32()),
            pa.array([batch.column("slab")[row].as_py()] * len(out["size"]), pa.int64()),
            pa.array(out["keys"], pa.binary()),
            pa.array(out["counts"], pa.binary()),
        ],
        names=["size", "part", "slab", "keys", "counts"],
    )


def _added(table: pa.Table) -> pa.Table:
    """The corpus's count of every key of every slab, in the order of the slab's keys; on one row, all counts and how many are not 0."""
    slabs = table.column("slab").to_pylist()
    keys = [unpack_sorted(blob) for blob in table.column("keys").to_pylist()]
    counts = np.concatenate([unpack_counts(blob) for blob in table.column("counts").to_pylist()])
    ends = np.cumsum([0, *map(len, keys)])
    distinct, at, _ = ranked(np.concatenate(keys))
    # Bounded by the tokens of the corpus, so doubles hold the sums exactly.
    total = np.bincount(at, counts, len(distinct)).astype(np.int64)
    first = [1] + [0] * (len(slabs) - 1)
    return pa.table(
        {
            "size": table.column("size"),
            "part": table.column("part"),
            "slab": table.column("slab"),
            "counts": pa.array([pack_counts(total[at[a:b]]) for a, b in zip(ends, ends[1:])], pa.binary()),
            "all": pa.array([int(total.sum()) * f for f in first], pa.int64()),
            "known": pa.array([int((total > 0).sum()) * f for f in first], pa.int64()),
        }
    )


# --- the automaton ----------------------------------------------------------------------------


class Automaton:
    """The part of the model that some texts can reach: states are histories that the corpus has, 0 the empty one.

    An arc leads from a state by a word to the longest known history that then holds, and weighs log10 of the word's probability. A state without an
    arc for a word has its failure arc to the history without its first word, which weighs `backoff`. At state 0 every word has an arc.

    A word has an add-one probability. After a history, it has its count there, and `prior` times its probability after the
    shorter history, over the history's count and `prior`; so a history's probabilities sum to 1, and a word that never followed it has
    the shorter history's probability times prior / (count + prior).
    """

    def __init__(self, grams: Grams, counts: list[np.ndarray], total: int, distinct: int, p: Parameters):
        one, two, three = counts
        self.words = len(one)
        # Where in the tokens an n-gram's last word is.
        first = grams.found
        ends = grams.keys[0] == END
        word_of_two, prefix_of_two = grams.at[0][first[1]], grams.at[0][first[1] - 1]
        word_of_three, prefix_of_three, suffix_of_three = grams.at[0][first[2]], grams.at[1][first[2] - 1], grams.at[1][first[2]]

        # State numbers: words, then pairs of words.
        kind = grams.at[0].dtype
        state_of_word = np.where((one > 0) & ~ends, np.cumsum((one > 0) & ~ends, dtype=kind), kind.type(0))
        many = int(state_of_word.max(initial=0))
        open_pair = (two > 0) & ~ends[word_of_two] if len(two) else np.zeros(0, bool)
        state_of_pair = np.where(open_pair, many + np.cumsum(open_pair, dtype=kind), kind.type(0))
        states = many + int(open_pair.sum()) + 1
        self.fail = np.zeros(states, kind)
        lends = np.zeros(states)
        lends[state_of_word] = np.log10(p.prior / (one + p.prior))
        self.fail[state_of_pair[open_pair]] = state_of_word[word_of_two[open_pair]]
        lends[state_of_pair[open_pair]] = np.log10(p.prior / (two[open_pair] + p.prior))
        lends[0] = 0.0
        self.backoff = lends

        unigram = (one + 1.0) / (total + distinct + 1.0)
        self.unigram, self.after_word = np.log10(unigram), state_of_word
        bigram = (two + p.prior * unigram[word_of_two]) / (one[prefix_of_two] + p.prior)
        seen_two, seen_three = np.flatnonzero(two > 0), np.flatnonzero(three > 0)
        suffix, prefix = suffix_of_three[seen_three], prefix_of_three[seen_three]
        trigram = (three[seen_three] + p.prior * bigram[suffix]) / (two[prefix] + p.prior)
        weight = np.log10(np.concatenate((bigram[seen_two], trigram)))
        del bigram, trigram
        leads_to = np.concatenate((state_of_pair[seen_two], state_of_pair[suffix]))
        key = np.concatenate(
            (
                self._arcs(state_of_word[prefix_of_two[seen_two]], word_of_two[seen_two]),
                self._arcs(state_of_pair[prefix], word_of_three[seen_three]),
            )
        )
        del prefix, suffix, seen_two, seen_three
        # Arcs lie in buckets by their hashes, as many buckets as arcs at least: `begin` says where each begins.
        self.shift = np.uint64(64 - max(1, len(key).bit_length()))
        bucket = mix(key) >> self.shift
        self.begin = np.zeros((1 << int(64 - self.shift)) + 1, kind)
        np.cumsum(np.bincount(bucket.view(np.int64), minlength=len(self.begin) - 1), out=self.begin[1:])
        order = ordered(bucket)
        del bucket
        self.arc, self.leads_to, self.weight = key[order], leads_to[order], weight[order]

    def _arcs(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """One number for each state and word."""
        return state.astype(np.uint64) * np.uint64(self.words) + word.astype(np.uint64)

    def _found(self, sought: np.ndarray) -> np.ndarray:
        """Where these arcs are, -1 for those that there are not."""
        out = np.full(len(sought), -1, self.begin.dtype)
        bucket = (mix(sought) >> self.shift).astype(np.int64)
        at, end, left = self.begin[bucket], self.begin[bucket + 1], np.arange(len(sought))
        going = at < end
        while going.any():
            at, end, left, sought = at[going], end[going], left[going], sought[going]
            same = self.arc[at] == sought
            out[left[same]] = at[same]
            at = at + 1
            going = ~same & (at < end)
        return out

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after one word each, and log10 of its probability, along failure arcs where there is no other."""
        total, after = np.zeros(len(state)), np.zeros(len(state), self.fail.dtype)
        left, now = np.arange(len(state)), state
        while len(left):
            empty = now == 0
            if empty.any():
                done = left[empty]
                total[done] += self.unigram[word[done]]
                after[done] = self.after_word[word[done]]
                left, now = left[~empty], now[~empty]
            at = self._found(self._arcs(now, word[left]))
            found = at >= 0
            total[left[found]] += self.weight[at[found]]
            after[left[found]] = self.leads_to[at[found]]
            left, now = left[~found], now[~found]
            total[left] += self.backoff[now]
            now = self.fail[now]
        return after, total

    def walk(self, words: np.ndarray, bounds: np.ndarray, segment: int) -> np.ndarray:
        """log10 probability of each text, read from left to right.

        A long text is read as several segments side by side: two words, the longest history, fix the state, so a segment begins
        with the two words before it, which it does not weigh.
        """
        sizes = np.diff(bounds)
        parts = -(-sizes // segment)
        text = np.repeat(np.arange(len(sizes)), parts)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = bounds[:-1][text] + nth * segment
        lead = np.minimum(nth * segment, 2)
        length = np.minimum(segment, sizes[text] - nth * segment) + lead
        order = np.argsort(-length, kind="stable")
        text, start, lead, length = text[order], start[order] - lead[order], lead[order], length[order]
        state, score = np.zeros(len(text), self.fail.dtype), np.zeros(len(text))
        for at in range(int(length.max(initial=0))):
            going = int(np.searchsorted(-length, -at, side="left"))
            state, weight = self.step(state[:going], words[start[:going] + at])
            score[:going] += np.where(at >= lead[:going], weight, 0.0)
        return np.bincount(text, score, len(sizes))


def _walked(batches: Iterator[pa.RecordBatch], total: int, distinct: int, bits: int, p: Parameters):
    for batch in batches:
        for row in range(batch.num_rows):
            yield _scores(batch, row, total, distinct, bits, p)
            pa.default_memory_pool().release_unused()


def _scores(batch: pa.RecordBatch, row: int, total: int, distinct: int, bits: int, p: Parameters) -> pa.RecordBatch:
    """The rows of one slab's texts; nothing else of the slab is held while the next is worked on."""
    grams = Grams(batch.column("texts")[row].values, bits)
    taught = _taught(batch, row, grams)
    short = batch.column("found")[row].as_py()
    counts = [_counts_of(short, 0), _counts_of(short, 1), _own(grams, 2, taught)]
    # What nobody else can have is counted by the slab alone.
    counts[2][_asked(grams, taught, counts[1])] = _counts_of(batch.column("longer")[row].as_py(), 2)
    del short, taught
    model = Automaton(grams, counts, total, distinct, p)
    words = grams.at[0]
    score = model.walk(words, grams.bounds, p.segment)
    sizes = np.diff(grams.bounds)
    text = np.repeat(np.arange(len(sizes)), sizes)
    return pa.record_batch(
        [
            batch.column("docs")[row].values,
            pa.array(sizes),
            pa.array(np.bincount(text, counts[0][words] > 0, len(sizes)).astype(np.int64)),
            pa.array(np.full(len(sizes), total, np.int64)),
            pa.array(np.bincount(text, model.unigram[words], len(sizes))),
            pa.array(score),
        ],
        names=["doc", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def score(
    docs: DataFrame,
    training: Column,
    p: Parameters = Parameters(),
    *,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """log10 probabilities of all whole texts under a model of the texts for which `training` holds.

    The method: the n-grams of each slab of texts are sent by their keys, with their counts in its training texts, to the tasks that add
    them up, and the corpus's counts of the same n-grams come back to the slab; first words and pairs, then those of three words whose
    pairs other slabs have as well, since all others are the slab's alone. That is all of the model that its texts can
    reach: it becomes an automaton of states, arcs and failure arcs (`Automaton`), and one traversal of every text from left
    to right carries the state and adds up weights. A frequent n-gram is one key per slab, keys are spread evenly by hash, and the
    driver sees two totals.

    Returns `doc_id, n_tokens, n_known, train_tokens, base_score, score`, one row per row of `docs`. NULL
    and empty texts are the end token alone. Words are told apart by 64-bit hashes, n-grams by `bits` of them. Without training texts
    all counts are 0.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc"), F.coalesce(training, F.lit(False)).alias("taught"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    slabs = kept_slabs(slabs_of(rows, p.slab_bytes), min(50_000, max(1, math.ceil(size / (2 * p.slab_bytes)))))
    slabs = slabs.select("slab", "docs", "taughts", "texts")
    # A token takes two bytes at least.
    parts, bits = max(1, math.ceil(size / 2 / p.part_keys)), p.bits(size)

    def counted(given: DataFrame, sizes: tuple[int, ...]) -> tuple[DataFrame, DataFrame]:
        named = given.mapInArrow(
            lambda batches: _named(batches, parts, bits, sizes), "size int, part int, slab long, keys binary, counts binary"
        )
        shape = "size int, part int, slab long, counts binary, all long, known long"
        added = staged(named.groupBy("size", "part").applyInArrow(_added, shape), "counts")
        return added, added.groupBy("slab").agg(F.collect_list(F.struct("size", "part", "counts")).alias("found"))

    added, short = counted(slabs, (1, 2))
    of_words = added.filter("size = 1").agg(F.coalesce(F.sum("all"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0)))
    total, distinct = of_words.first()
    _, longer = counted(slabs.join(short, "slab"), (3,))
    kind = rows.schema["doc"].dataType.simpleString()
    known = slabs.join(short, "slab").join(longer.withColumnRenamed("found", "longer"), "slab", "left")
    walked = known.mapInArrow(
        lambda batches: _walked(batches, total, distinct, bits, p),
        f"doc {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    return walked.withColumnRenamed("doc", doc_id)
