"""N-gram Jaccard join: universe partition, pigeonhole and one-deletion neighbourhoods."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarrymill.llm.bytewords import NOT_BLANK, Words, mix, slices
from quarrymill.llm.common import bounded, mapped, staged
from quarrymill.llm.components import components
from quarrymill.operators.skew import own_shuffle

# Sizes of one band differ by less than this factor.
BAND_RATIO = 1.4
# A bucket of more members in several components is crowded: it yields no pairs unless pigeonhole needs it.
CROWDED = 64
# Classes that a task remembers to have indexed.
REMEMBERED = 1 << 14
# Bits of a set's sketch: two per element, up to this many.
MOST_SKETCH_BITS = 4096


@dataclass(frozen=True)
class Likeness:
    """Two sets are linked if `per` * |common| >= `least` * |union|."""

    shingle: int = 4
    least: int = 85
    per: int = 100

    def most_different(self, total: int) -> int:
        """The most elements that linked sets of `total` elements together can have apart."""
        return (self.per - self.least) * total // (self.per + self.least)

    def largest(self, size: int) -> int:
        """The largest set that one of `size` elements can be linked to."""
        return self.per * size // self.least

    def smallest(self, size: int) -> int:
        return -(-self.least * size // self.per)


@dataclass(frozen=True)
class Band:
    """How sets whose smaller one has `low` to `high` elements are cut.

    `apart` elements at most differ, so of `apart` + 1 segments one is equal. Some segments more make up for those
    of a set that are empty or crowded; the first `deletions` of them are also indexed with each element left out and
    so count twice, as they find partners that differ there by one.
    """

    low: int
    high: int
    apart: int
    segments: int
    deletions: int


@lru_cache(maxsize=None)
def bands(likeness: Likeness) -> tuple[Band, ...]:
    out, low = [], 1
    while low < 2**31:
        high = max(low, int(low * BAND_RATIO) - 1)
        apart = likeness.most_different(high + likeness.largest(high))
        extra, deletions = 2 + apart // 16, 1 + apart // 32
        out.append(Band(low, high, apart, apart + 1 + extra, deletions))
        low = high + 1
    return tuple(out)


@lru_cache(maxsize=None)
def _lows(likeness: Likeness) -> np.ndarray:
    return np.array([b.low for b in bands(likeness)])


def bands_of(size: int, likeness: Likeness) -> range:
    """The bands in which a set meets its partners: its own and those of smaller ones."""
    lows = _lows(likeness)
    first = int(np.searchsorted(lows, likeness.smallest(size), side="right")) - 1
    return range(first, int(np.searchsorted(lows, size, side="right")))


_CLASS = np.uint64(0x2545F4914F6CDD1D)


def class_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set of distinct hashes, whatever their order."""
    total = mix(shingles + _CLASS).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(shingles))]))[0].astype(np.int64))


def signatures(shingles: np.ndarray, number: int, band: Band) -> tuple[np.ndarray, np.ndarray, int]:
    """(signatures of segments, signatures of segments less one element, spare).

    A segment's signature is a sum over its elements, so that leaving one out is a subtraction. `spare` is how many
    further segments may drop out before pigeonhole fails; if it is below 0, empty segments have signatures too.
    """
    m = np.uint64(band.segments)
    segment = (shingles % m).astype(np.int64)
    value = mix(shingles + np.uint64(number + 1))
    sums = np.zeros(band.segments, np.uint64)
    np.add.at(sums, segment, value)
    sizes = np.bincount(segment, minlength=band.segments)
    names = mix(np.arange(band.segments, dtype=np.uint64) + np.uint64((number + 1) << 32))
    spare = int((sizes > 0).sum() + (sizes[: band.deletions] > 1).sum()) - band.apart - 1
    own = mix(sums + names)
    if spare >= 0:
        own = own[sizes > 0]
    less = (segment < band.deletions) & (sizes[segment] > 1)
    return own, mix(sums[segment[less]] - value[less] + names[segment[less]]), spare


def sketch(shingles: np.ndarray, band: Band) -> np.ndarray:
    """The parity of the number of elements that fall on each bit, as 64-bit numbers.

    An element that two sets do not share flips one bit, so sketches differ in no more bits than sets do in elements.
    """
    bits = min(64 * -(-2 * band.high // 64), MOST_SKETCH_BITS)
    odd = np.bincount((mix(shingles ^ _CLASS) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def sets_of(words: Words, size: int) -> list[np.ndarray]:
    """The distinct shingles of each text; of a text of fewer words, all words as one."""
    n = len(words.bounds) - 1
    grams, owner = words.grams(size)
    cuts = np.searchsorted(owner, np.arange(n + 1))
    out = []
    for k in range(n):
        if cuts[k] < cuts[k + 1]:
            out.append(np.unique(grams[cuts[k] : cuts[k + 1]]))
        else:
            few = words.hashes[words.bounds[k] : words.bounds[k + 1]]
            total = np.full(min(1, len(few)), np.uint64(size * 1009 + len(few)))
            for h in few:
                total = mix(total + h)
            out.append(total)
    return out


def _shingle_sets(text: pa.Array, size: int):
    for first, last, words in slices(text, NOT_BLANK):
        yield from zip(range(first, last), sets_of(words, size))


_IN_BANDS = "array<struct<band: long, spare: long, sketch: array<long>>>"
_ARROW_IN_BANDS = pa.list_(
    pa.struct([("band", pa.int64()), ("spare", pa.int64()), ("sketch", pa.list_(pa.int64()))])
)


def _described(likeness: Likeness):
    """doc, n, class and, for each of its bands, spare and sketch of each text."""

    def work(batches):
        for batch in batches:
            n, name, spare = [], [], []
            for _, shingles in _shingle_sets(batch.column(1), likeness.shingle):
                n.append(len(shingles))
                name.append(class_of(shingles))
                own = []
                for b in bands_of(len(shingles), likeness) if len(shingles) else ():
                    band = bands(likeness)[b]
                    if band.apart:
                        own.append(
                            {"band": b, "spare": signatures(shingles, b, band)[2], "sketch": sketch(shingles, band)}
                        )
                spare.append(own)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(name, pa.int64()), pa.array(spare, _ARROW_IN_BANDS)],
                names=["doc", "n", "class", "bands"],
            )

    return work


def _indexed(likeness: Likeness):
    """signature, class, tag of each segment; tag holds the set's size, the band and whether an element is left out."""

    def work(batches):
        held: list[list[np.ndarray]] = [[], [], []]
        seen: set[int] = set()
        for batch in batches:
            for _, shingles in _shingle_sets(batch.column(0), likeness.shingle):
                if not len(shingles):
                    continue
                # Copies are indexed once per task; should more classes come than are remembered, some are once more.
                name = class_of(shingles)
                if name in seen:
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(name)
                for b in bands_of(len(shingles), likeness):
                    band = bands(likeness)[b]
                    if not band.apart:
                        continue  # only equal sets are linked, and those are one class
                    own, less, _ = signatures(shingles, b, band)
                    tag = (len(shingles) << 8) + 2 * b
                    n = len(own) + len(less)
                    held[0] += [own, less]
                    held[1].append(np.full(n, name))
                    held[2] += [np.full(len(own), tag), np.full(len(less), tag + 1)]
                if len(held[1]) >= 300:
                    yield _columns(held)
                    held = [[], [], []]
        if held[1]:
            yield _columns(held)

    return work


def _columns(held: list[list[np.ndarray]]) -> pa.RecordBatch:
    signature = np.concatenate(held[0]).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(signature), pa.array(np.concatenate(held[1])), pa.array(np.concatenate(held[2]))],
        names=["signature", "class", "tag"],
    )


def _fetched(likeness: Likeness):
    """class and set, as sorted 64-bit hashes end to end, of each text."""

    def work(batches):
        for batch in batches:
            name, data = [], []
            for _, shingles in _shingle_sets(batch.column(0), likeness.shingle):
                name.append(class_of(shingles))
                data.append(shingles.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(name, pa.int64()), pa.array(data, pa.binary())], names=["class", "shingles"]
            )

    return work


def _verified(likeness: Likeness):
    def work(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                common = len(np.intersect1d(a, b, assume_unique=True))
                good.append(likeness.per * common >= likeness.least * (len(a) + len(b) - common))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(good, pa.bool_())) for c in (batch.column(0), batch.column(1))], names=["a", "b"]
            )

    return work


def _deleted() -> Column:
    return F.expr("tag & 1")


def _size() -> Column:
    return F.expr("shiftright(tag, 8)")


def _band() -> Column:
    return F.expr("shiftright(tag & 255, 1)")


def _of_size(x, y, likeness: Likeness):
    return likeness.per * F.least(x, y) >= likeness.least * F.greatest(x, y)


def _may_be_alike(a: str, b: str, likeness: Likeness) -> Column:
    """Whether sizes and sketches of the rows `a` and `b` (with tag and sketch) leave a link possible."""
    x, y = (F.expr(f"shiftright({row}.tag, 8)") for row in (a, b))
    flipped = F.zip_with(f"{a}.sketch", f"{b}.sketch", lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    differ = F.aggregate(flipped, F.lit(0), lambda total, n: total + n)
    most = (likeness.per - likeness.least) * (x + y)
    return _of_size(x, y, likeness) & (differ * (likeness.per + likeness.least) <= most)


def _components(given: DataFrame, likeness: Likeness) -> tuple[DataFrame, DataFrame]:
    """(doc, n, class) of each row of `given` (doc, text), and (class, label, doc): the component of each class, its smallest id."""
    described = staged(
        given.mapInArrow(_described(likeness), f"doc long, n long, class long, bands {_IN_BANDS}"), "described"
    )
    # Rows of a class agree in all but their ids.
    classes = described.filter("n > 0 AND doc IS NOT NULL").groupBy("class").agg(F.min("doc").alias("doc"))
    classes = staged(classes, "classes")
    own = described.select("doc", "class", F.explode("bands").alias("b")).select("doc", "class", "b.*")
    in_bands = staged(own.join(classes, ["class", "doc"], "left_semi").dropDuplicates(["class", "band"]), "in_bands")
    in_bands = in_bands.drop("doc")

    index = given.filter("doc IS NOT NULL").select("text").mapInArrow(
        _indexed(likeness), "signature long, class long, tag long"
    )
    bucket = Window.partitionBy("signature")
    shared = (
        index.withColumn("low", F.min("class").over(bucket))
        .withColumn("high", F.max("class").over(bucket))
        .withColumn("whole", F.min(_deleted()).over(bucket))
        .filter("low <> high AND whole = 0")
        .select("signature", "class", "tag")
        .distinct()
    )
    shared = staged(shared, "buckets")
    linked = _links(given, classes, _first_pairs(shared, in_bands, likeness), likeness)
    labels = components(linked)

    later = _later_pairs(shared, classes, in_bands, labels, likeness)
    if not later.isEmpty():
        more = _links(given, classes, later, likeness)
        linked = staged(linked.unionByName(more), "all_links")
        labels = components(linked)

    named = staged(_named(classes, labels), "labelled")
    smallest = named.groupBy("label").agg(F.min("doc").alias("doc"))
    return described.select("doc", "n", "class"), named.select("class", "label").join(smallest, "label")


def _named(classes: DataFrame, labels: DataFrame) -> DataFrame:
    """class, doc, label: the smallest class that links lead to."""
    found = labels.withColumnRenamed("node", "class")
    return classes.join(found, "class", "left").select("class", "doc", F.coalesce("label", "class").alias("label"))


def similar_sets(
    docs: DataFrame, likeness: Likeness = Likeness(), *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Join texts whose sets of word shingles are alike, and name the component of each.

    The method: equal sets are one class. The universe of shingles is cut into segments by hash, their number by
    the size band of the smaller set; linked sets differ in fewer elements than there are segments, so one segment is
    equal. Segments are indexed by signatures, the first few with each element left out as well. A set pays for its
    empty and crowded segments out of what that leaves spare. Candidates that share a bucket are verified
    on their shingles, if sizes and parity sketches do not rule them out: first each member against the
    bucket's smallest, then, where a bucket still holds several components, all pairs from different ones. Crowded buckets are left out of the second step except
    among sets that have nothing spare: a pair either of whose sets can spare its crowded buckets has met elsewhere.
    So no link between components is lost, and pairs within a component are not made.

    Returns `doc_id, n_shingles, component_id`, one row per row of `docs`: the set's size and the smallest id
    that links lead to. Words are separated by blanks, A-Z is lower-cased. Texts of fewer words than a shingle are
    one shingle; NULL and empty texts have none and no links. Rows with a NULL id have no component and link
    nothing; rows that repeat an id are each in the component of their text. Shingles and sets are told apart by
    64-bit hashes.
    """
    described, named = _components(docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")), likeness)
    named = named.select(F.col("class").alias("of"), F.col("doc").alias("least"))
    out = described.join(named, (F.col("n") > 0) & (F.col("class") == F.col("of")), "left")
    return out.select(
        F.col("doc").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc").isNotNull(), F.coalesce("least", "doc")).alias("component_id"),
    )


def _first_pairs(shared: DataFrame, in_bands: DataFrame, likeness: Likeness) -> DataFrame:
    """x, y: each member of a bucket with the bucket's smallest whole segment."""
    bucket = Window.partitionBy("signature")
    whole = F.when(_deleted() == 0, F.struct(F.col("class").alias("class"), F.col("tag").alias("tag")))
    pairs = (
        shared.withColumn("first", F.min(whole).over(bucket))
        .filter((F.col("class") != F.col("first.class")))
        .filter(_of_size(_size(), F.expr("shiftright(first.tag, 8)"), likeness))
        .select(
            _band().alias("band"), "class", "tag",
            F.col("first.class").alias("first_class"), F.col("first.tag").alias("first_tag"),
        )
        .distinct()
    )
    sketches = in_bands.select("class", "band", "sketch")
    first = sketches.toDF("first_class", "band", "first_sketch")
    both = pairs.join(sketches, ["class", "band"]).join(first, ["first_class", "band"])
    both = both.select(
        F.struct("class", "tag", "sketch").alias("a"),
        F.struct(F.col("first_class").alias("class"), F.col("first_tag").alias("tag"),
                 F.col("first_sketch").alias("sketch")).alias("b"),
    )
    return (
        both.filter(_may_be_alike("a", "b", likeness))
        .select(F.least("a.class", "b.class").alias("x"), F.greatest("a.class", "b.class").alias("y"))
        .distinct()
    )


def _later_pairs(
    shared: DataFrame, classes: DataFrame, in_bands: DataFrame, labels: DataFrame, likeness: Likeness
) -> DataFrame:
    """x, y: pairs from different components that share a bucket, as far as pigeonhole needs them."""
    named = staged(_named(classes, labels).select("class", "label"), "named")
    bucket = Window.partitionBy("signature")
    open_ = (
        shared.join(named, "class")
        .withColumn("low", F.min("label").over(bucket))
        .withColumn("high", F.max("label").over(bucket))
        .withColumn("members", F.count(F.lit(1)).over(bucket))
        .filter("low <> high")
        .select("signature", "class", "tag", "label", _band().alias("band"), (F.col("members") > CROWDED).alias("crowded"))
    )
    open_ = staged(open_, "open")
    # A whole segment may be one that counts twice.
    lost = (
        open_.filter("crowded")
        .groupBy("class", "band")
        .agg(F.sum(F.when(_deleted() == 0, 2).otherwise(1)).alias("lost"))
    )
    poor = (
        in_bands.select("class", "band", "spare")
        .join(lost, ["class", "band"], "left")
        .filter("spare < coalesce(lost, 0)")
        .select("class", "band")
    )
    calm = open_.filter("NOT crowded")
    needed = open_.filter("crowded").join(poor, ["class", "band"], "left_semi")
    members = staged(calm.unionByName(needed), "open_members")
    # The buckets of a set in a band, at most two per segment and element.
    kept = members.groupBy("class", "band").agg(
        F.collect_set(F.when(_deleted() == 0, F.col("signature"))).alias("whole"),
        F.collect_set(F.when(_deleted() == 1, F.col("signature"))).alias("less"),
    )
    members = members.join(in_bands.select("class", "band", "sketch"), ["class", "band"]).join(kept, ["class", "band"])
    members = staged(members.select("signature", "class", "tag", "label", "sketch", "whole", "less"), "members")
    a, b = members.alias("a"), members.alias("b")
    # Alike sets share many buckets; a pair is made in the first of them only.
    shared_by = [("whole", "whole"), ("whole", "less"), ("less", "whole")]
    first = F.least(*[F.array_min(F.array_intersect(f"a.{x}", f"b.{y}")) for x, y in shared_by])
    possible = (
        (F.col("a.signature") == F.col("b.signature"))
        & F.expr("a.class < b.class AND a.label <> b.label AND (a.tag & b.tag & 1) = 0")
        & _may_be_alike("a", "b", likeness)
        & (F.col("a.signature") == first)
    )
    return staged(a.join(b, possible).select(F.col("a.class").alias("x"), F.col("b.class").alias("y")).distinct(), "later")


def _links(given: DataFrame, classes: DataFrame, pairs: DataFrame, likeness: Likeness) -> DataFrame:
    """a, b: those pairs of classes whose sets are alike."""
    pairs = staged(pairs, "pairs")
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("class")).distinct()
    wanted = bounded(staged(wanted.join(classes, "class").select("class", "doc"), "wanted"))
    texts = given.join(wanted.select("doc"), "doc", "left_semi").select("text")
    # A repeated id may stand for another text as well: only sets that are wanted stay, one of each class.
    sets = texts.mapInArrow(_fetched(likeness), "class long, shingles binary")
    sets = sets.join(wanted.select("class"), "class").groupBy("class").agg(F.first("shingles").alias("shingles"))
    sets = staged(sets, "sets")
    left, right = sets.toDF("x", "s"), sets.toDF("y", "t")
    both = pairs.join(left, "x").join(right, "y").select(F.col("x").alias("a"), F.col("y").alias("b"), "s", "t")
    return staged(both.mapInArrow(_verified(likeness), "a long, b long"), "verified")


def _classed(likeness: Likeness, at: int):
    """The class of the text in column `at`; None where it has no shingles."""

    def work(batches):
        for batch in batches:
            name = [class_of(s) if len(s) else None for _, s in _shingle_sets(batch.column(at), likeness.shingle)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(name, pa.int64())], names=[*batch.schema.names, "class"]
            )

    return work


def remove_similar(
    docs: DataFrame, likeness: Likeness = Likeness(), *, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`docs` with one row of each component of texts, that of the smallest id; columns as they were.

    Rows are judged by their text, so an id that stands for several texts may lose one and keep another. Of rows that agree in id and
    shingles one stays, and of unlike texts of one component under the smallest id one too. Rows with a NULL id, or without words, stay.
    """
    described, named = _components(docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")), likeness)
    rows = described.filter("n > 0 AND doc IS NOT NULL").select("doc", "class").distinct()
    rows = staged(rows.join(named.select("class", "label"), "class"), "rows")
    chosen = rows.groupBy("label").agg(F.min(F.struct("doc", "class")).alias("kept"))
    # A large component is one label: a shuffle of its own lets Spark split it.
    judged = rows.join(own_shuffle(chosen, "label"), "label").withColumn("stays", F.struct("doc", "class") == F.col("kept"))
    judged = staged(judged.select("doc", "class", "stays"), "judged")
    # Ids of one row are judged by id alone; texts are only looked at again for ids of several rows.
    several = described.filter("doc IS NOT NULL").groupBy("doc").count().filter("count > 1").select("doc")
    several = staged(several, "several")
    gone = staged(judged.filter("NOT stays").join(several, "doc", "left_anti").select("doc"), "gone")

    # By place, so that no column of the table can clash with those needed here.
    places = [f"__{i}" for i in range(len(docs.columns))]
    id_place = places[docs.columns.index(doc_id)]
    placed = docs.toDF(*places)
    same_id = F.col(id_place) == F.col("doc")
    kept = placed.join(bounded(gone), same_id, "left_anti")
    if not several.isEmpty():
        listed = bounded(several)
        own = _one_of_each(placed.join(listed, same_id, "left_semi"), judged.join(several, "doc", "left_semi"), likeness, id_place, docs.columns.index(text))
        kept = kept.join(listed, same_id, "left_anti").unionByName(own)
    return kept.toDF(*docs.columns)


def _one_of_each(rows: DataFrame, judged: DataFrame, likeness: Likeness, id_place: str, at_text: int) -> DataFrame:
    """Of rows that share ids with others: one of each id and class that stays, and those without words."""
    places = rows.columns
    classed = mapped(rows, _classed(likeness, at_text), _CLASS_COLUMN).toDF(*places, "__own")
    same = (F.col(id_place) == F.col("doc")) & (F.col("__own") == F.col("class"))
    stays = bounded(staged(judged.filter("stays").select("doc", "class"), "stays"))
    once = classed.join(stays, same, "left_semi").dropDuplicates([id_place, "__own"])
    return classed.filter("__own IS NULL").unionByName(once).select(*places)


_CLASS_COLUMN = StructType([StructField("class", LongType())])
