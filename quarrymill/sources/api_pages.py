"""Landed pages of a list API: `{object, url, has_more, data: [...]}`, one JSON document each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions.columns import exact
from quarrymill.functions.inference import infer_json_types, type_json
from quarrymill.operators.lineage import Scratch
from quarrymill.operators.skew import own_shuffle

# Elements of `data` are kept as JSON text; their own keys are typed later.
_PAGE_SHAPE = "object string, url string, has_more boolean, data array<string>"


def read_pages(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """`(value, file)`: one page per line, or one (possibly pretty-printed) page per file."""
    text = spark.read.text(path, wholetext=one_per_file)
    return text.select("value", F.col("_metadata.file_path").alias("file"))


def page_number_in_name(file: Column | str) -> Column:
    """The last run of digits in a file's name."""
    return F.regexp_extract(file, r"(\d+)\D*$", 1).try_cast("bigint")


def scan_api_pages(pages: DataFrame, value: str = "value") -> DataFrame:
    """One row per element of `data`: its position in the page and its JSON as `record`.

    All other columns of `pages` stay, so a page number among them keeps the page order.
    """
    others = [exact(name) for name in pages.columns if name != value]
    page = F.from_json(F.col(value), _PAGE_SHAPE, {"mode": "FAILFAST"})
    opened = pages.select(*others, page.alias("\0page"))
    return opened.select(*others, F.posexplode(F.col("\0page.data")).alias("position", "record"))


def typed_records(records: DataFrame, first_page_only: Column | None = None) -> DataFrame:
    """Flatten `record` into typed columns.

    Types come from all records, or from the ones `first_page_only` selects, which is how a
    client that must decide early sees them: later values that do not fit then fail the load.
    """
    sample = records if first_page_only is None else records.filter(first_page_only)
    return type_json(records, "record", infer_json_types(sample, "record"))


def page_chain_audit(
    pages: DataFrame,
    stream: str,
    page: str,
    has_more: str,
    rows: str,
    last_id: str,
    starting_after: str | None = None,
) -> DataFrame:
    """`(stream, page, problem)` for every break of the paging contract.

    A chain runs over consecutive page numbers, ends at `has_more = false` or an empty page, and
    asks each next page for what follows the last id of the one before. Each page meets its
    successor in an equi-join on (stream, page), which spreads a long chain over all tasks, where
    a window would put it into one.
    """
    numbered = pages.select(
        F.col(stream).alias("stream"),
        F.col(page).cast("bigint").alias("page"),
        F.col(has_more).alias("has_more"),
        F.col(rows).cast("bigint").alias("rows"),
        F.col(last_id).cast("string").alias("last_id"),
        (F.col(starting_after) if starting_after else F.lit(None)).cast("string").alias("after"),
    )
    copies = numbered.groupBy("stream", "page").agg(
        F.count(F.lit(1)).alias("copies"),
        F.max("has_more").alias("has_more"),
        F.max("rows").alias("rows"),
        F.max("last_id").alias("last_id"),
        F.max("after").alias("after"),
    )
    ends = copies.groupBy("stream").agg(F.min("page").alias("first"), F.max("page").alias("last"))
    previous = copies.select(
        "stream",
        (F.col("page") + 1).alias("page"),
        F.lit(True).alias("follows"),
        F.col("has_more").alias("before_has_more"),
        F.col("last_id").alias("before_last_id"),
    )
    # One stream may be most of the pages: let that join be split at run time.
    chained = copies.join(previous, ["stream", "page"], "left").join(own_shuffle(ends, "stream"), "stream")
    follows = F.coalesce(F.col("follows"), F.lit(False))
    is_first, is_last = F.col("page") == F.col("first"), F.col("page") == F.col("last")
    checks = {
        "copied": F.col("copies") > 1,
        "gap before": ~is_first & ~follows,
        "after the end": follows & ~F.col("before_has_more"),
        "cut off": is_last & F.col("has_more") & (F.col("rows") > 0),
        "empty": ~is_last & (F.col("rows") == 0),
        "no id": ~is_last & F.col("has_more") & F.col("last_id").isNull(),
    }
    if starting_after:
        checks["wrong cursor"] = follows & ~F.col("after").eqNullSafe(F.col("before_last_id"))
    found = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in checks.items()]))
    return chained.select("stream", "page", F.explode(found).alias("problem"))


def rank_pages(pages: DataFrame, stream: str, page: str, after: str, last_id: str) -> DataFrame:
    """`(stream, page, head, rank, problem)` of pages that know only after which id they begin and with which they end.

    A page follows the one whose last id it begins after; one that begins after nothing is a chain's head, and has rank 0. Pointers to
    the page before jump over each other, so a chain of any length is ranked in as many rounds as its length has binary digits, spread
    over all tasks. `page` names pages uniquely. Problems, NULL for none:

    - `lost head`: it begins after an id that no page of its stream ends with; the rest of its chain is ranked from it
    - `fork`: another page begins after the same id; both are ranked
    - `shared id`: another page ends with the same id; what follows is ranked after the one with the smaller name
    - `cycle`: it is on a closed chain, or follows one, and has neither head nor rank
    """
    scratch = Scratch(pages.sparkSession)
    own, _, _ = scratch.write(
        pages.select(
            F.col(stream).alias("stream"), F.col(page).alias("page"),
            F.col(after).cast("string").alias("after"), F.col(last_id).cast("string").alias("last_id"),
        )
    )
    ends = own.filter("last_id is not null").groupBy("stream", F.col("last_id").alias("after")).agg(
        F.min("page").alias("before"), F.count(F.lit(1)).alias("ending")
    )
    begins = own.filter("after is not null").groupBy("stream", "after").agg(F.count(F.lit(1)).alias("beginning"))
    known = own.join(ends, ["stream", "after"], "left").join(begins, ["stream", "after"], "left")
    shared = ends.filter("ending > 1").select("stream", F.col("after").alias("last_id"), F.lit(True).alias("shared"))
    known = known.join(shared, ["stream", "last_id"], "left").select(
        "stream", "page", F.coalesce("before", "page").alias("up"), F.col("before").isNull().alias("is_head"),
        F.when(F.col("before").isNull() & F.col("after").isNotNull(), "lost head")
        .when(F.col("beginning") > 1, "fork").when(F.col("shared"), "shared id").alias("problem"),
    )
    linked, many, _ = scratch.write(known)
    steps = F.when(F.col("is_head"), 0).otherwise(1).cast("bigint")
    ranked = linked.select("stream", "page", "up", steps.alias("rank"), F.col("is_head").alias("done"))
    jumped, reach = many, 1
    while jumped and reach <= 2 * many:
        over = ranked.select("stream", F.col("page").alias("up"), F.col("up").alias("next"), F.col("rank").alias("more"), F.col("done").alias("ends"))
        ranked = ranked.join(over, ["stream", "up"]).select(
            "stream", "page", F.col("next").alias("up"), (F.col("rank") + F.col("more")).alias("rank"),
            (F.col("done") | F.col("ends")).alias("done"), (~F.col("done") & ~F.col("ends")).alias("open"),
        )
        ranked, jumped = scratch.write_counting(ranked, "open")
        reach *= 2
    closed = ~F.col("done")
    result = linked.select("stream", "page", "problem").join(ranked, ["stream", "page"])
    result, _, path = scratch.write(
        result.select(
            "stream", "page", F.when(~closed, F.col("up")).alias("head"), F.when(~closed, F.col("rank")).alias("rank"),
            F.coalesce("problem", F.when(closed, "cycle")).alias("problem"),
        )
    )
    scratch.keep_only([path])
    return result
