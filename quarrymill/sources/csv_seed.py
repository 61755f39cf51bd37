"""CSV lookup files: scan, name by path, load with inferred types."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.functions.inference import type_csv
from quarrymill.sinks.store import LoadResult, Store, write_replace
from quarrymill.sources.csv_splits import scan_records

_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}


def _larger_than_a_split(spark: SparkSession, path: str) -> bool:
    """Whether a file at `path` is more than one task should read. The listing reads no contents."""
    files = spark.read.format("binaryFile").load(path).select("length")
    largest = files.agg(F.max("length")).first()[0] or 0
    # Sizes may be set as `128m`; Spark itself says what that is.
    limit = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return largest > limit


def scan_csv_text(spark: SparkSession, path: str, multiline: bool = True, split: bool | None = None) -> DataFrame:
    """Header and quoted fields, every column as text.

    Short rows are padded with NULL, extra fields dropped, blank lines skipped, empty fields NULL.
    A quoted field may hold line breaks. Files of more than one split are read by several tasks all the same, which
    takes a pass of its own (`csv_splits`); `split` asks for that, or against it, whatever their size. Pass
    `multiline=False` for files known to have no such fields, which Spark splits without that pass.
    """
    whole = (
        spark.read.option("header", True).option("multiLine", multiline).option("enforceSchema", True).options(**_OPTIONS)
    ).csv(path)
    if not multiline or not (_larger_than_a_split(spark, path) if split is None else split):
        return whole
    # Of `whole` only the header is read. Fields go by place, as names may repeat in other letters.
    places = ", ".join(f"c{i} string" for i in range(len(whole.columns)))
    records = scan_records(spark, path).filter("NOT first")
    fields = records.select(F.from_csv("record", places, _OPTIONS).alias("\0r"))
    return fields.select(*[F.col("\0r")[f"c{i}"].alias(name) for i, name in enumerate(whole.columns)])


def scan_csv_seed(spark: SparkSession, path: str, multiline: bool = True, split: bool | None = None) -> DataFrame:
    """The same with the column types its values show."""
    return type_csv(scan_csv_text(spark, path, multiline, split))


def scan_seed_tree(spark: SparkSession, root: str) -> DataFrame:
    """`(name, path, bytes)` of every seed below a folder.

    A seed is a `.csv` file, or a `.csv` folder of part files as Spark writes them. Its table is
    `seed_` and the relative path without the suffix, `/` as `_`. The listing reads no contents.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(root)
        .select("path", "length")
    )
    # Listed paths are whole ones, so the root is made whole first.
    whole = spark._jvm.org.apache.hadoop.fs.Path(root)
    whole = whole.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(whole).toString()
    relative = F.substr(F.col("path"), F.lit(len(whole.rstrip("/")) + 2))
    seed = F.regexp_extract(relative, r"^(.*?\.csv)(/|$)", 1)
    return (
        files.withColumn("seed", seed)
        .groupBy("seed")
        .agg(F.sum("length").alias("bytes"))
        .select(
            F.concat(
                F.lit("seed_"), F.translate(F.regexp_replace("seed", r"\.csv$", ""), "/", "_")
            ).alias("name"),
            F.concat(F.lit(root.rstrip("/") + "/"), "seed").alias("path"),
            "bytes",
        )
    )


def load_seeds(store: Store, root: str, multiline: bool = True) -> list[LoadResult]:
    """Replace the table of every seed. Two paths with one table name are an error."""
    paths = defaultdict(list)
    for row in scan_seed_tree(store.spark, root).collect():
        paths[row["name"]].append(row["path"])
    clashes = {name: found for name, found in paths.items() if len(found) > 1}
    if clashes:
        raise ValueError(f"several seeds share a table name: {clashes}")
    return [
        write_replace(store, name, scan_csv_seed(store.spark, found[0], multiline))
        for name, found in sorted(paths.items())
    ]
