"""A corpus pipeline of five operators: each stage works on all the rows its predecessor kept.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a
DataFrame. ``run`` writes each stage's rows as Parquet and gives them to the next. All stages
but the last return the columns of their input; the last returns one row per document in the
token files. Toxicity is learned, so no SQL gives the rows.

Edge cases: null and empty texts, null ids, repeated rows, very long texts, extra columns of
any name and empty tables pass every stage. A null or empty text has fingerprint zero, so one
such row at most stays after SimHash; it has size zero, so the mix takes none of it. An empty
table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowloom.llm import decontaminate, mixing, simhash, token_output, toxicity
from rowloom.llm.common import bounded, discard, scratch, scratch_for, table
from rowloom.llm.queries import TOKENIZER

ORACLE_SQL = None


@bounded
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; all labels may teach."""
    weights = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, weights)


@bounded
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class: four-word shingles, at most four bits apart."""
    return simhash.one_of_each(docs)


@bounded
def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


@bounded
def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_rows(docs)


@bounded
def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: place and checksum of every document in them."""
    path = scratch(spark, "tokens")
    token_output.write_tokens(docs, path, TOKENIZER, end_id=1)
    return token_output.read_tokens(spark, path, digest=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("token_output", tokenized),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's scratch data and its input go once it is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch(spark, f"stage-{name}")
        with scratch_for(spark, f"work-{name}"):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            discard(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
