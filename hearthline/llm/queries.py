"""The numbered queries over the given tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.llm import align, ctw, decontaminate, hardnegatives, langid, minhash, mixing, neighbours, oracles, parity, secrets, sharding, tokens, urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bottom_k_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "chance")


#: host, path, whether it blocks
URL_RULES = (("net", "/", True), ("example.net", "/en/", False), ("example.com", "/de/", True), ("org", "/fr/", False))


def op3_url_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs that a rule fits are the labelled ones."""
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op4_context_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score_documents(_table(spark, sf_dir, "documents"))


def op5_trigram_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    n = [F.col("counts")[k].alias(f"n_{r.kind}") for k, r in enumerate(secrets.BASE)]
    return found.select("doc_id", *n, "base_sha256", "spans")


def op6_multiprobe_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op7_permutation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.place(docs).select("doc_id", "source", "slot", "shard")


def op8_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in which a benchmark item occurs, with the item, its edits and its end in the plain text."""
    found = decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "edits", "end")


def op9_wavelet_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokens.token_output(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op10_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.detect_languages(_table(spark, sf_dir, "documents"))


def op11_anchor_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align_documents(_table(spark, sf_dir, "documents"), a, b, digest=True).withColumnRenamed("groups", "groups_sha256")


def op12_parity_sketch_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity.similar_documents(_table(spark, sf_dir, "documents"))


def op13_hilbert_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardnegatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numbered = (
        op1_bottom_k_near_dedup, op2_pareto_mix, op3_url_regression, op4_context_tree_score, op5_trigram_secret_scan, op6_multiprobe_neighbours, op7_permutation_shards,
        op8_pigeonhole_decontamination, op9_wavelet_token_ids, op10_language_mixture, op11_anchor_alignment, op12_parity_sketch_join, op13_hilbert_hard_negatives,
    )
    return {f.__name__: f for f in numbered}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
