"""A corpus from `documents`: quality, near duplicates, secrets, mixture, packing, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from countyloom.llm import jaccard_join, mixing, packing, quality, secret_scan
from countyloom.llm.common import shared_folder, small_batches, table
from countyloom.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.score(docs, model).where("predicted = 1").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose word 5-grams link at 0.75 or more."""
    return jaccard_join.keep_one(docs)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secret_scan.redacted(docs, secret_scan.train(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which blocks of the sources interleave to their target weights."""
    return mixing.mixed_order(docs, mixing.tempered())


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, packed into sequences that are numbered in the order in which the mixture left the rows."""
    return packing.pack(docs, tokenizer_path(), in_order=True, kept=KEPT_CHUNKS)


#: Chunks of text that a worker remembers while it packs, beside what the stages before have left in it.
KEPT_CHUNKS = 100_000
STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", hide_secrets),
    ("mixture", mix),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage is written to the shared folder and read again."""
    root = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):  # every stage is written inside
        for name, stage in STAGES:
            stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
            docs = spark.read.parquet(f"{root}/{name}")
    return docs
