"""The operators as registered queries over the test tables, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from countyloom.llm import (
    ann_forest,
    conversation_repair,
    jaccard_join,
    license_scan,
    mixing,
    packing,
    quality,
    ranked_search,
    secret_scan,
    sharding,
    sql,
    toxicity,
    url_cascade,
    vector_dedup,
)
from countyloom.llm.common import held_out, table

SHARDS = 8
RULES = [
    url_cascade.Rule("allow", "com", "/"),
    url_cascade.Rule("block", "example.com", "/en/"),
    url_cascade.Rule("allow", "www.example.com", "/en/"),
    url_cascade.Rule("block", "net", "/es/"),
    url_cascade.Rule("block", "net", "/fr/"),
]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaves = sharding.topology(SHARDS)
    return sharding.shard_documents(table(spark, sf_dir, "documents"), leaves, sharding.grow(leaves))


def op2_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op3_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge(table(spark, sf_dir, "pages"), RULES)


def op4_pfair_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return mixing.mix_sources(docs, mixing.tempered()).drop("n_chars")


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join_documents(table(spark, sf_dir, "documents"), count_links=True).drop("class")


def op6_sorted_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.dedup(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.scan(docs, secret_scan.train(docs)))


def op9_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = quality.score(docs.select("doc_id", "text"), quality.train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.digest(license_scan.scan(docs, license_scan.rank_words(docs)))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.digest(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hash_tree_shards": op1_hash_tree_shards,
    "op2_hash_forest": op2_hash_forest,
    "op3_url_cascade": op3_url_cascade,
    "op4_pfair_mixture": op4_pfair_mixture,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_sorted_passes": op6_sorted_passes,
    "op7_toxicity": op7_toxicity,
    "op8_markov_secrets": op8_markov_secrets,
    "op9_vector_packing": op9_vector_packing,
    "op10_quality": op10_quality,
    "op11_ranked_search": op11_ranked_search,
    "op12_license_scan": op12_license_scan,
    "op13_conversation_repair": op13_conversation_repair,
}


def oracle_sql() -> dict[str, str]:
    return sql.statements()
