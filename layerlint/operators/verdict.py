"""Counters, thresholds, verdict and summaries of jobs.

Everything is folded per chunk first (combined on the map side), and per job after that, through blocks of chunks where
order matters. No step gathers the rows of a job in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from layerlint import constants as K
from layerlint.config import LIMITS, Limits
from layerlint.functions.rounding import share_exceeds
from layerlint.operators.errors import checker_counts
from layerlint.operators.schema import check_features

# Chunks per block in ordered folds.
CHUNK_BLOCK = 4096


def _block() -> Column:
    return F.floor(F.col("chunk_id") / CHUNK_BLOCK)


def feature_stats(features: DataFrame) -> DataFrame:
    """Features and vertices per job."""
    return features.groupBy("job_id").agg(
        F.count(F.lit(1)).alias("total_features"), F.coalesce(F.sum("vertices"), F.lit(0)).cast("bigint").alias("total_vertices"),
    )


def empty_layers(jobs: DataFrame, features: DataFrame) -> DataFrame:
    """Jobs without any feature, with the error this is."""
    return jobs.join(features.select("job_id").distinct(), "job_id", "left_anti").withColumn(
        "error", F.lit("layer has no features")
    )


def error_counts(errors: DataFrame) -> DataFrame:
    """The seven counters per job of an error table; every error row counts."""
    return errors.groupBy("job_id").agg(
        *[F.count_if(F.col("type") == t).alias(counter) for t, _, counter in K.ERROR_TYPES]
    )


def has_errors(jobs: DataFrame, errors: DataFrame) -> DataFrame:
    """Whether a job has any error row, critical or not."""
    found = errors.groupBy("job_id").agg(F.lit(True).alias("has_errors"))
    return jobs.select("job_id").join(found, "job_id", "left").withColumn("has_errors", F.coalesce("has_errors", F.lit(False)))


def chunk_feature_counts(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Vertex and metadata errors per chunk with feature totals, in one pass that builds no message."""
    return check_features(features, limits).groupBy("job_id", "chunk_id").agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if("skipped").alias("vertices"),
        F.count_if("broken").alias("metadata"),
    )


def chunk_holes_of(chunk_results: DataFrame) -> DataFrame:
    """Small holes per chunk of nested checker results, with ``has_parts``."""
    return chunk_results.select("job_id", "chunk_id", "small_holes_count", (F.size("parts") > 0).alias("has_parts"))


def chunk_counts(
    features: DataFrame, part_errors: DataFrame, chunk_holes: DataFrame, limits: Limits = LIMITS,
) -> DataFrame:
    """All seven counters per chunk, the features in it, and its small holes (0 where the checker reported no part).

    ``chunk_holes`` may say itself which chunks have parts (``has_parts``); else those with a row in ``part_errors`` do.
    """
    checked = [c for c in K.COUNTERS if c not in ("vertices", "metadata")]
    zero, no = F.lit(0).cast("bigint"), F.lit(False)
    told = "has_parts" in chunk_holes.columns
    in_chunk = F.col("job_id").isNotNull() & F.col("chunk_id").isNotNull()
    # A checker may also report the first two types itself, so both sources add up. Stacking the three narrow tables and
    # summing once replaces outer joins on the same key, and the look for chunks with parts.
    parts = [
        chunk_feature_counts(features, limits).select(
            "job_id", "chunk_id", "features", "vertices", "metadata", *[zero.alias(c) for c in checked],
            zero.alias("holes"), no.alias("resolution_exceeded"), F.lit(True).alias("counted"), no.alias("has_holes"), no.alias("has_parts"),
        ),
        checker_counts(part_errors, features, limits).select(
            "job_id", "chunk_id", zero.alias("features"), "vertices", "metadata", *checked,
            F.lit(None).cast("bigint").alias("holes"), "resolution_exceeded", no.alias("counted"), no.alias("has_holes"),
            (no if told else in_chunk).alias("has_parts"),
        ),
        (chunk_holes.filter("has_parts") if told else chunk_holes).select(
            "job_id", "chunk_id", zero.alias("features"), zero.alias("vertices"), zero.alias("metadata"),
            *[zero.alias(c) for c in checked], F.col("small_holes_count").alias("holes"), no.alias("resolution_exceeded"),
            no.alias("counted"), F.lit(True).alias("has_holes"), F.lit(told).alias("has_parts"),
        ),
    ]
    return (
        reduce(DataFrame.unionByName, parts).groupBy("job_id", "chunk_id").agg(
            *[F.sum(c).alias(c) for c in ["features", *K.COUNTERS, "holes"]],
            *[F.max(c).alias(c) for c in ("resolution_exceeded", "counted", "has_holes", "has_parts")],
        )
        # holes count where the checker reported parts, and such a chunk counts even without features
        .filter(F.col("counted") | (F.col("has_holes") & F.col("has_parts")))
        .withColumn("holes", F.when(F.col("has_parts"), F.col("holes")).otherwise(0))
        .drop("counted", "has_holes", "has_parts")
    )


def job_counts(chunks: DataFrame) -> DataFrame:
    """Per-chunk counters folded per job.

    ``holes_basis`` is the number of small-hole errors up to the last chunk with small holes: the share of small holes is
    looked at in such chunks only, against the errors counted so far. It is NULL if no chunk has small holes. Blocks find
    it locally; the last block with holes adds the totals of the blocks before it.
    """
    in_block = Window.partitionBy("job_id", "block")
    last_hole = F.max(F.when(F.col("holes") > 0, F.col("chunk_id"))).over(in_block)
    totals = ["features", *K.COUNTERS, "holes"]
    blocks = (
        chunks.withColumn("block", _block()).withColumn("last_hole", last_hole)
        .groupBy("job_id", "block").agg(
            *[F.sum(c).alias(c) for c in totals],
            F.max("resolution_exceeded").alias("resolution_exceeded"),
            F.max("last_hole").alias("last_hole"),
            F.sum(F.when(F.col("chunk_id") <= F.col("last_hole"), F.col("smallHoles"))).alias("until_hole"),
        )
    )
    before = Window.partitionBy("job_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    basis = F.when(F.col("last_hole").isNotNull(), F.coalesce(F.sum("smallHoles").over(before), F.lit(0)) + F.col("until_hole"))
    return (
        blocks.withColumn("basis", basis).groupBy("job_id").agg(
            *[F.sum(c).alias(c) for c in totals],
            F.max("resolution_exceeded").alias("resolution_exceeded"),
            # counts only grow, so the largest basis is the latest
            F.max("basis").alias("holes_basis"),
        )
    )


def thresholds(counts: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Add the three threshold results to job counters with ``features``, ``holes`` and ``holes_basis``."""
    return counts.withColumns({
        "small_geometries_exceeded": share_exceeds(F.col("smallGeometries"), F.col("features"), limits.small_geometries_pct),
        "small_holes_exceeded": F.coalesce(
            share_exceeds(F.col("holes_basis"), F.col("features"), limits.small_holes_pct), F.lit(False)
        ),
    })


def is_critical() -> Column:
    """Any critical counter above zero, or a small-* share exceeded. A resolution error counts even if not exceeded."""
    counted = reduce(lambda a, b: a | b, [F.col(c) > 0 for c in K.CRITICAL_COUNTERS])
    return counted | F.col("small_geometries_exceeded") | F.col("small_holes_exceeded")


def verdict(counts: DataFrame) -> DataFrame:
    """Add ``has_critical_errors`` and ``is_valid`` to counters with thresholds."""
    return counts.withColumn("has_critical_errors", is_critical()).withColumn("is_valid", ~F.col("has_critical_errors"))


def job_verdicts(
    features: DataFrame, part_errors: DataFrame, chunk_holes: DataFrame, limits: Limits = LIMITS,
) -> DataFrame:
    """Counters, thresholds and verdict of every job with features."""
    return verdict(thresholds(job_counts(chunk_counts(features, part_errors, chunk_holes, limits)), limits))


def feature_verdicts(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Verdict from vertex and metadata errors alone, before any checker result: one shuffle of combined counters."""
    counts = check_features(features, limits).groupBy("job_id").agg(
        F.count(F.lit(1)).alias("features"), F.count_if("skipped").alias("vertices"), F.count_if("broken").alias("metadata"),
    )
    critical = (F.col("vertices") > 0) | (F.col("metadata") > 0)
    return counts.withColumn("is_valid", ~critical)


def errors_summary(verdicts: DataFrame) -> DataFrame:
    """One nested summary per job: seven counters and three thresholds."""
    return verdicts.select("job_id", summary_struct().alias("summary"))


def summary_struct() -> Column:
    return F.struct(
        F.struct(*[F.col(c).cast("bigint").alias(c) for c in K.COUNTERS]).alias("errorsCount"),
        F.struct(
            F.struct(F.col("small_geometries_exceeded").alias("exceeded")).alias("smallGeometries"),
            F.struct(F.col("small_holes_exceeded").alias("exceeded"), F.col("holes").cast("bigint").alias("count")).alias("smallHoles"),
            F.struct(F.col("resolution_exceeded").alias("exceeded")).alias("resolution"),
        ).alias("thresholds"),
    )


def _keywords(summary: Column) -> Column:
    """Label and value pairs of a summary: the counts, then the thresholds."""
    counts = [
        F.struct(F.lit(K.COUNT_LABELS[c]).alias("label"), summary["errorsCount"][c].cast("string").alias("value"))
        for c in K.SUMMARY_COUNTERS
    ]
    checks = [
        F.struct(F.lit(label).alias("label"),
                 F.when(summary["thresholds"][key]["exceeded"], "Failed").otherwise("Passed").alias("value"))
        for key, label in K.THRESHOLD_LABELS
    ]
    return F.array(*counts, *checks)


def summary_keywords(summaries: DataFrame) -> DataFrame:
    """Ten rows per job: seven counts, then three thresholds as Passed or Failed."""
    return (
        summaries.select("job_id", F.posexplode(_keywords(F.col("summary"))).alias("position", "k"))
        .select("job_id", "position", "k.label", "k.value")
    )


def summary_document(summaries: DataFrame, jobs: DataFrame) -> DataFrame:
    """One XML text per job. ``jobs`` gives ``task_id``, ``job_type`` and ``title``."""
    keywords = F.transform(
        _keywords(F.col("summary")), lambda k: F.struct(k["label"].alias("_vocabulary"), k["value"].alias("keyword"))
    )
    record = F.struct(
        F.col("task_id").cast("string").alias("identifier"), F.col("job_id").cast("string").alias("parentidentifier"),
        F.col("job_type").alias("type"), "title", F.lit(K.SUMMARY_ABSTRACT).alias("abstract"), keywords.alias("keywords"),
    )
    xml = F.to_xml(record, {"rowTag": "qgis", "attributePrefix": "_"})
    header = F.lit('<?xml version="1.0" encoding="UTF-8"?>\n')
    return summaries.join(jobs, "job_id").select("job_id", F.concat(header, xml).alias("document"))


def _counts_so_far(chunks: DataFrame) -> DataFrame:
    """Counters up to and with each chunk, ``resolution_exceeded`` so far, and ``holes_basis`` as in ``job_counts``.

    One scan over the composite state (sums, flag, small-hole errors at the last chunk with holes): blocks of chunks are scanned
    in parallel, and one row per block is scanned across them. Both read the chunks of one exchange.
    """
    counted = ["features", *K.COUNTERS, "holes"]
    block = F.coalesce(_block(), F.lit(0))
    here = Window.partitionBy("job_id", "block").orderBy("chunk_id").rowsBetween(Window.unboundedPreceding, 0)
    inside = (
        chunks.repartition(F.col("job_id"), block).withColumn("block", block)
        .select("job_id", "chunk_id", "block", *[F.sum(c).over(here).alias(f"w_{c}") for c in counted],
                F.max("resolution_exceeded").over(here).alias("w_res"), F.col("holes").alias("step_holes"))
        .withColumn("w_basis", F.max(F.when(F.col("step_holes") > 0, F.col("w_smallHoles"))).over(here))
    )
    # counts only grow, so the largest of a block is that of its end
    ends = inside.groupBy("job_id", "block").agg(*[F.max(f"w_{c}").alias(f"e_{c}") for c in [*counted, "res", "basis"]])
    before = Window.partitionBy("job_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.select("job_id", "block", *[F.coalesce(F.sum(f"e_{c}").over(before), F.lit(0)).alias(f"c_{c}") for c in counted],
                    F.max("e_res").over(before).alias("c_res"), "e_basis")
        .withColumn("c_basis", F.max(F.col("c_smallHoles") + F.col("e_basis")).over(before)).drop("e_basis")
    )
    return inside.join(carried, ["job_id", "block"]).select(
        "job_id", "chunk_id", *[(F.col(f"c_{c}") + F.col(f"w_{c}")).alias(c) for c in counted],
        F.greatest("c_res", "w_res").alias("resolution_exceeded"),
        F.greatest(F.col("c_basis"), F.col("c_smallHoles") + F.col("w_basis")).alias("holes_basis"),
    )


def running_summary(chunks: DataFrame, totals: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Counters and thresholds after each chunk. ``totals`` gives ``total_features`` per job."""
    measured = _counts_so_far(chunks).drop("features").join(totals.select("job_id", F.col("total_features").alias("features")), "job_id")
    return verdict(thresholds(measured, limits)).select(
        "job_id", "chunk_id", *K.COUNTERS, "holes", "small_geometries_exceeded", "small_holes_exceeded", "resolution_exceeded",
    )
