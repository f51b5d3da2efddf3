"""The registered query of each operator, with production parameters, and its SQL where SQL can give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from layerlint.llm import decontamination, jaccard, langid, linededup, mixing, packing, periodic, quality, secrets, sharding, spelling, toxicity, warc
from layerlint.session import new_folder, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages"), new_folder(spark, "warc"))


def op2_secret_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op3_token_group_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents")).drop("node")


def op4_simhash_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_passages(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op6_pairwise_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(_table(spark, sf_dir, "documents"))


def op7_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copy numbers are ints, as in the SQL; the operator's own are bigints, for documents with more than 2^31 copies."""
    mixed = mixing.mix_sources(_table(spark, sf_dir, "documents"))
    return mixed.withColumn("copy_no", F.col("copy_no").cast("int"))


def op8_bitmask_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op9_kd_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``bytes``: the shards' sizes are near equal."""
    rows = sharding.shard_documents(_table(spark, sf_dir, "documents"), 40)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_tfidf_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_exact_complements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_frequency_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(_table(spark, sf_dir, "documents"), "[A-Za-z\u00C0-\u00FF]+", 6, 5, typos=199)
    return spelling.variants(written(words, "spelling-words"))


def op13_diagonal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", periodic.planted(F.col("text"), F.col("doc_id")).alias("text"))
    return periodic.digests(periodic.find_runs(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_warc_chunks, op2_secret_battery, op3_token_group_matrix, op4_simhash_windows, op5_divergence_rules, op6_pairwise_alignment,
        op7_poisson_mix, op8_bitmask_filters, op9_kd_tree_shards, op10_tfidf_neighbours, op11_exact_complements, op12_frequency_trie, op13_diagonal_runs,
    )
}

SQL: dict[str, str] = {
    "op7_poisson_mix": mixing.MIX_SQL + "SELECT doc_id, text, lang, source, n_chars, CAST(unnest(generate_series(0, n - 1)) AS INT) AS copy_no FROM counts WHERE n > 0",
}
