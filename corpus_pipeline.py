"""From raw documents to training blocks in five stages. Each stage works on all that the one
before kept; its result is written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import common, decontaminate, mixing, near_join, secrets, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field, trained on `labels`, scores below 0.5."""
    return toxicity.without_toxic(docs, common.table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each class of the n-gram Jaccard join."""
    return near_join.without_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of `benchmark`."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; secrets in their texts are replaced, and n_chars is that of the text."""
    out = secrets.redacted(docs)
    changed = out["n_chars"].isNotNull() & out["text"].isNotNull()
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: fixed-length blocks at their places in output shards."""
    return mixing.mixed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

ORACLE_SQL = None  # a trained model, a random permutation: tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
