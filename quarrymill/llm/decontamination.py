"""Benchmark decontamination: a prefix-filtered join of word shingles, verified on the words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import alphanumeric_words, bounded, gram_hash, rolling, staged

WINDOW_WORDS = 10
SHINGLE_WORDS = 3


def _windows(items: DataFrame, text: str, item_id: str, window: int) -> DataFrame:
    """item, words: every run of `window` words of an item, or all its words if there are fewer."""
    worded = items.select(F.col(item_id).alias("item"), alphanumeric_words(F.col(text)).alias("all")).filter(
        F.size("all") > 0
    )
    length = F.least(F.lit(window), F.size("all"))
    starts = worded.select("item", "all", F.explode(F.sequence(F.lit(1), F.size("all") - length + 1)).alias("at"))
    return starts.select("item", F.slice("all", F.col("at"), length).alias("words"))


def _shingles(windows: DataFrame, size: int) -> DataFrame:
    """win, words, offset, shingle: the shingles of each window, of `size` words or of all if there are fewer."""
    parts = []
    for k in range(1, size + 1):
        own = windows.filter(F.size("words") == k) if k < size else windows.filter(F.size("words") >= size)
        grams = own.select("win", "words", F.posexplode(rolling("words", k)).alias("offset", "gram"))
        parts.append(
            grams.filter(F.col("offset") <= F.size("words") - k).select(
                "win", "words", "offset", F.lit(k).alias("size"), gram_hash("gram", k).alias("shingle")
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _document_shingles(docs: DataFrame, text: str, carried: list[Column], sizes: list[int]) -> DataFrame:
    """One row per word of a document with the shingle that starts there, one row for a document without words."""
    most = max([*sizes, 1])
    worded = docs.select(*carried, alphanumeric_words(F.col(text)).alias("doc_words"))
    names = worded.columns
    grams = worded.select(*names, F.posexplode_outer(rolling("doc_words", most)).alias("at", "gram"))
    if len(sizes) < 2:
        return grams.select(*names, "at", gram_hash("gram", most).alias("shingle"))
    keys = F.array(*[gram_hash("gram", k) for k in sizes])
    return grams.select(*names, "at", F.explode(keys).alias("shingle"))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """Which words of which documents lie in a window of a benchmark item.

    The method: all shingles of the windows are counted over all documents. A window occurs only where
    each of its shingles does, so its necessary prefix is the one shingle that is rarest by these
    counts, and documents are joined on prefixes alone. A candidate's place follows from the shingle's
    offset; it must begin and end within the document, and the words there must equal the window's.
    Neither texts nor words are shuffled: both passes join against shingles of the items, which are
    broadcast if they were counted to be few, and only occurrences leave a task.

    Returns `doc_id, n_words, n_hit, items (sorted strings), n_items, contaminated`, one row for each row
    of `docs`, also for repeated ids. NULL and empty texts have no words. Items without words have no
    windows, repeated items count once, and a NULL item id marks words but is not listed.
    """
    spark = docs.sparkSession
    windows = _windows(items, item_text, item_id, window)
    distinct = staged(windows.select("words").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
    owners = staged(
        windows.join(distinct, "words").select("win", F.col("item").cast("string").alias("item")).distinct(), "owners"
    )
    shingles = staged(_shingles(distinct, shingle), "shingles")
    sizes = sorted(row["size"] for row in shingles.select("size").distinct().collect())  # at most `shingle` rows
    wanted = bounded(staged(shingles.select("shingle").distinct(), "wanted"))

    counts = (
        _document_shingles(docs, text, [], sizes)
        .join(wanted, "shingle")
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    rarest = F.min_by(F.struct("offset", "shingle"), F.struct(F.coalesce("rows", F.lit(0)), "offset"))
    prefix = (
        shingles.join(counts, "shingle", "left")
        .groupBy("win", "words")
        .agg(rarest.alias("rare"))
        .select("win", "words", F.col("rare.offset").alias("offset"), F.col("rare.shingle").alias("shingle"))
    )
    prefix = bounded(staged(prefix, "prefix"))

    carried = [F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc")]
    d = _document_shingles(docs, text, carried, sizes).withColumn("n_words", F.size("doc_words")).alias("d")
    start = F.col("d.at") - F.col("p.offset")
    length = F.size("p.words")
    verified = (
        (F.col("d.shingle") == F.col("p.shingle"))
        & (start >= 0)
        & (start + length <= F.col("d.n_words"))
        & (F.slice("d.doc_words", F.greatest(start, F.lit(0)) + 1, length) == F.col("p.words"))
    )
    found = (
        d.join(prefix.alias("p"), verified, "left")
        .filter(F.col("win").isNotNull() | F.col("at").isNull() | (F.col("at") == 0))
        .select("row", "doc", "n_words", "win", start.alias("start"), (start + length).alias("stop"))
        .distinct()
    )
    found = staged(found, "occurrences")

    before = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.coalesce(F.max("stop").over(before), F.lit(0))
    new = F.greatest(F.col("stop") - F.greatest("start", seen), F.lit(0))
    covered = (
        found.withColumn("new", F.coalesce(new, F.lit(0)))
        .groupBy("row", "doc", "n_words")
        .agg(F.sum("new").cast("long").alias("n_hit"))
    )
    named = (
        found.join(owners, "win")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    none = F.array().cast("array<string>")
    return (
        covered.join(named, "row", "left")
        .withColumn("items", F.coalesce("items", none))
        .select(
            F.col("doc").alias(doc_id),
            F.col("n_words").cast("long").alias("n_words"),
            "n_hit",
            "items",
            F.size("items").cast("long").alias("n_items"),
            (F.col("n_hit") > 0).alias("contaminated"),
        )
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose text holds no window of a benchmark item; columns as they were.

    A document goes by its id. Rows without an id go by their text instead.
    """
    doc_id, text = options.get("doc_id", "doc_id"), options.get("text", "text")
    own = "__contaminated_key"
    key = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("sha256:"), F.sha2(F.col(text), 256)))
    keyed = docs.withColumn(own, key)
    found = contamination(
        keyed.select(F.col(own).alias("key"), F.col(text).alias("text")),
        items,
        **{**options, "doc_id": "key", "text": "text"},
    )
    bad = staged(found.filter("contaminated").select(F.col("key").alias(own)).distinct(), "contaminated")
    return keyed.join(bad, own, "left_anti").drop(own)
