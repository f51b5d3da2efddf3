"""Documents made ready for training: language, near duplicates, benchmark passages, mixture and shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from layerlint.llm import decontamination, jaccard, langid, mixing, sharding
from layerlint.session import prepare, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.2  # share of a text's n-grams that the language found must have
SHARDS = 40


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Those without a letter, and those too far from every language, go."""
    prepare(spark)
    learned = docs.filter(~langid.held_out() & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("key"), "text", "lang")
    found = langid.predict_languages(docs, langid.learn_filters(learned), keep=COLUMNS)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the row with the group's id, or the first of rows with that id.

    Rows without id or without words are kept.
    """
    classes = jaccard.near_duplicates(docs)
    # one row per doc_id: equal ids with different texts count as one document
    kept = written(classes.filter("doc_id is not null and n_shingles > 0").groupBy("doc_id").agg(F.min(F.col("doc_id") == F.col("component_id")).alias("first")).filter("not first").select("doc_id"), "pipeline-duplicates")
    return docs.join(kept, "doc_id", "left_anti").select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Decided by the text, so that every row of a contaminated text goes, with or without id, and no other row of its id.
    """
    return decontamination.without_passages(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that every source has the same weight, in a global random order."""
    return mixing.mix_sources(docs).select(*COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its place in it."""
    return sharding.shard_documents(docs, SHARDS, keep=list(COLUMNS))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: SQL has neither the learned language filters nor the similarity search; the tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents of a folder, each stored in the shared folder before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
