"""The corpus pipeline: five stages, each on what the one before has kept.

Every stage takes (spark, docs, sf_dir) and is written as Parquet and read again before the next. All but the last
return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrymill.llm import decontamination, jaccard, packing, pii, toxicity
from quarrymill.llm.common import in_fold, prepare, staged, table
from quarrymill.llm.queries import TOXIC_FROM, packed_digest, tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; learned from the labels outside the held-out fold."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels")
    return toxicity.remove_toxic(docs, labels, ~in_fold("doc_id", 3, 1), TOXIC_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose sets of five-word shingles are alike by 0.8 or more."""
    prepare(spark)
    return jaccard.remove_similar(docs, jaccard.Likeness(shingle=5, least=80))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    prepare(spark)
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data replaced by its kind, and `n_chars` of the new text."""
    prepare(spark)
    redacted = pii.redact(docs, pii.fit(docs))
    if "n_chars" not in docs.columns:
        return redacted
    kind = docs.schema["n_chars"].dataType
    return redacted.withColumn("n_chars", F.char_length("text").cast(kind))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in training sequences."""
    prepare(spark)
    return packed_digest(packing.pack(docs, tokenizer_file()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

# Training, components of links and tokenizing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from `documents` on."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
