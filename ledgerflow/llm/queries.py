"""The registered queries of the llm operators: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import (
    ann,
    decontam,
    filter_audit,
    langid,
    minhash,
    packing,
    quality,
    sharding,
    substring,
    token_counts,
    token_matrix,
    url_filter,
    whitening,
)
from ledgerflow.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that are not held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


def op4_co_trained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from co-trained text and metadata views."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a passage of a test item, one row a pair."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens (final id 1)."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), capacity=2048, final_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


#: The rules of the contract (fixed values).
URL_RULES = [
    url_filter.Rule("allow", "com/"),
    url_filter.Rule("block", "example.com/en/"),
    url_filter.Rule("allow", "www.example.com/en/"),
    url_filter.Rule("block", "net/es/"),
    url_filter.Rule("block", "net/fr/"),
]


def op5_url_word_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge(pages, url_filter.train(pages), URL_RULES).drop("block_odds")


def op8_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of each vector whose id is divisible by 100."""
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op6_bpe_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, tokens and the over-limit flag of every document."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), limit=2048)


def op7_best_fit_token_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed id matrix of all documents, one row a sequence of 2048 ids."""
    return token_matrix.pack_matrices(table(spark, sf_dir, "documents"), capacity=2048)


def op10_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of all documents, equal texts together, the largest shard as small as possible."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components at 3-word shingles, Jaccard >= 0.85."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85, den=100)


def op11_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of 50-word passages that an earlier one holds."""
    return substring.remove_repeats(table(spark, sf_dir, "documents"), window=50)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the first four whitened components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=4)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_cost_balanced_packing": op2_cost_balanced_packing,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_co_trained_quality": op4_co_trained_quality,
    "op5_url_word_filter": op5_url_word_filter,
    "op6_bpe_token_counts": op6_bpe_token_counts,
    "op7_best_fit_token_matrix": op7_best_fit_token_matrix,
    "op8_multiprobe_neighbours": op8_multiprobe_neighbours,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_minimax_shards": op10_minimax_shards,
    "op11_filter_interactions": op11_filter_interactions,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLES: dict[str, str] = {"op11_filter_interactions": filter_audit.ORACLE_SQL}
