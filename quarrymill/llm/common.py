"""What several of the operators need: staged tables, checked broadcasts, words as Spark arrays."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarrymill.session import pin, shared_dir

# A side with at most this many short rows is broadcast (about 64 MB); beyond it, joins shuffle.
MOST_BROADCAST_ROWS = 1_000_000
# Rows and bytes in one Arrow batch, so that a batch of very long texts still fits into a Python worker.
ROWS_PER_ARROW_BATCH, BYTES_PER_ARROW_BATCH = 1024, 8 << 20

# The letters that are lower-cased, and what separates words.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_ALPHANUMERIC = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that it need not be installed there."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="quarrymill-")) / package.name
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """Session options the operators depend on, and their code for the executors."""
    pin(spark)
    _ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_ARROW_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_ARROW_BATCH))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new place in the folder that the driver and all executors share."""
    return f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """`df` written as a table to the shared folder and read back: lineage is cut, executors may go."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int = MOST_BROADCAST_ROWS) -> DataFrame:
    """A staged table with a broadcast hint if it was counted to have at most `most` rows, else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all other letters as they are. Pure ASCII takes the faster built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def alphanumeric_words(text: Column) -> Column:
    """Lower-cased words of ASCII letters, digits and everything beyond ASCII. None in NULL."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_ALPHANUMERIC), "")


def rolling(words: str, size: int) -> Column:
    """`words` as an array of structs g0..g{size-1}: the word at each place and those after it, NULL past the end."""
    shifted = [F.col(words) if i == 0 else F.slice(words, i + 1, 2**30) for i in range(size)]
    return F.arrays_zip(*[column.alias(f"g{i}") for i, column in enumerate(shifted)])


def gram_hash(gram: str, size: int) -> Column:
    return F.xxhash64(*[F.col(f"{gram}.g{i}") for i in range(size)])


def in_fold(key: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; false for a NULL key."""
    crc = F.crc32(F.col(key).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def mapped(docs: DataFrame, work, added: StructType) -> DataFrame:
    """`docs.mapInArrow(work)` that keeps all columns, whatever their names, and adds `added`.

    `work` sees columns by place and returns them with the new ones behind.
    """
    by_place = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    fields = [*by_place.schema.fields, *added.fields]
    names = [field.name for field in fields]

    def renamed(batches):
        for batch in work(batches):
            yield batch.rename_columns(names)

    out = by_place.mapInArrow(renamed, StructType(fields))
    return out.toDF(*docs.columns, *[field.name for field in added.fields])
