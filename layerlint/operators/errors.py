"""Checker results, the error table and the wide per-feature report."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window, functions as F

from layerlint import constants as K
from layerlint.config import LIMITS, Limits
from layerlint.functions.text import repeat_joined
from layerlint.operators.schema import check_features, feature_errors
from layerlint.operators.skew import split_join

KEYS = ["job_id", "chunk_id", "id"]


def _literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])


def map_error_code(code: Column) -> Column:
    """Checker code to ``STRUCT<type, column_name, counter, message>``; an unlisted code is Unknown and its own message."""
    columns = {t: c for t, c, _ in K.ERROR_TYPES}
    counters = {t: c for t, _, c in K.ERROR_TYPES}
    resolved = F.when(code.isin(*columns), code).otherwise(F.lit(K.UNKNOWN))
    return F.struct(
        resolved.alias("type"),
        _literal_map(columns)[resolved].alias("column_name"),
        _literal_map(counters)[resolved].alias("counter"),
        F.coalesce(F.try_element_at(_literal_map(K.CHECKER_MESSAGES), code), code).alias("message"),
    )


def explode_errors(chunk_results: DataFrame) -> DataFrame:
    """Nested checker results to one row per error item. ``part`` and ``item`` keep the order of the lists."""
    parts = chunk_results.select("job_id", "chunk_id", F.posexplode("parts").alias("part", "p"))
    items = parts.select("job_id", "chunk_id", "part", F.col("p.id").alias("id"), F.posexplode("p.errors").alias("item", "e"))
    return items.select("job_id", "chunk_id", "id", "part", "item", F.col("e.code").alias("code"), F.col("e.isExceeded").alias("is_exceeded"))


def nest_errors(part_errors: DataFrame, chunk_holes: DataFrame) -> DataFrame:
    """Long checker output to one record per chunk. A chunk is vertex-bounded, so is its list."""
    parts = (
        part_errors.groupBy("job_id", "chunk_id")
        .agg(F.sort_array(F.collect_list(F.struct(
            "item", "id", F.array(F.struct("code", F.col("is_exceeded").alias("isExceeded"))).alias("errors")))).alias("p"))
        .select("job_id", "chunk_id", F.transform("p", lambda p: F.struct(p["id"].alias("id"), p["errors"].alias("errors"))).alias("parts"))
    )
    return chunk_holes.join(parts, ["job_id", "chunk_id"], "left").withColumn(
        "parts", F.coalesce("parts", F.array().cast("array<struct<id:string,errors:array<struct<code:string,isExceeded:boolean>>>>"))
    )


def last_by_id(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Position of the last feature under each id of a chunk, over-limit features left out.

    Only the position travels: a combinable ``max`` keeps a hot id (all features without one) from piling up in one task.
    """
    checked = check_features(features, limits)
    return (
        checked.filter(~F.col("skipped")).groupBy("job_id", "chunk_id", F.col("feature_key").alias("id"))
        .agg(F.max("ordinal").alias("feature_ordinal"))
    )


def dedupe_by_id(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """First position under each id of a chunk, and the last one that checker results can refer to (NULL if all are skipped)."""
    return check_features(features, limits).groupBy("job_id", "chunk_id", F.col("feature_key").alias("id")).agg(
        F.min("ordinal").alias("first_ordinal"), F.max(F.when(~F.col("skipped"), F.col("ordinal"))).alias("last_ordinal"),
    )


def attach_results(part_errors: DataFrame, features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Checker items whose id is in the chunk, with the position of the last feature under that id."""
    return split_join(part_errors, last_by_id(features, limits), KEYS)


def unmatched_results(part_errors: DataFrame, features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Checker items whose id is not in the chunk; they are never counted."""
    return split_join(part_errors, last_by_id(features, limits), KEYS, "left_anti")


def checker_errors(part_errors: DataFrame, features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Matched checker items as rows of the error table (phase 2). ``part`` orders parts, ``item`` the errors in one."""
    position = F.col("part") if "part" in part_errors.columns else F.lit(0)
    mapped = attach_results(part_errors, features, limits).withColumn("m", map_error_code(F.col("code")))
    return mapped.select(
        *KEYS, F.lit(2).alias("phase"), position.cast("bigint").alias("ordinal"), F.col("item").cast("bigint").alias("item"),
        "m.type", "m.column_name", "m.message", "feature_ordinal", "is_exceeded",
    )


def all_errors(features: DataFrame, part_errors: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Vertex, metadata and checker errors in one table."""
    return feature_errors(features, limits).unionByName(checker_errors(part_errors, features, limits))


def checker_counts(part_errors: DataFrame, features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Matched checker items counted per chunk; a chunk whose items match no feature has zeros.

    Items are summed per (job, chunk, id) before the join, so an id with very many items meets its feature as one row. Items
    without a match stay, so that the same pass tells which chunks the checker reported parts for.
    """
    m = map_error_code(F.col("code"))
    per_id = part_errors.groupBy(*KEYS).agg(
        *[F.count_if(m["counter"] == counter).alias(counter) for counter in K.COUNTERS],
        F.max(F.coalesce((m["type"] == K.RESOLUTION) & F.col("is_exceeded"), F.lit(False))).alias("resolution_exceeded"),
    )
    known = last_by_id(features, limits).select(*KEYS, F.lit(True).alias("matched"))
    matched = F.coalesce("matched", F.lit(False))
    return (
        per_id.join(known, KEYS, "left")
        .groupBy("job_id", "chunk_id")
        .agg(
            *[F.sum(F.when(matched, F.col(c)).otherwise(0)).alias(c) for c in K.COUNTERS],
            F.max(matched & F.col("resolution_exceeded")).alias("resolution_exceeded"),
        )
    )


# Columns of these types are filled with messages that differ from error to error; the others repeat one fixed message.
_VARYING = [K.VERTICES, K.METADATA, K.UNKNOWN]


# Bytes of text that a report cell may take.
CELL_BYTES = 1 << 20


def errors_by_feature(errors: DataFrame, most_bytes: int = CELL_BYTES) -> DataFrame:
    """One wide row per (job, chunk, id): messages of each type in arrival order, and the feature they belong to.

    Fixed messages are counted and repeated, so only varying ones are gathered, and only where their cell takes at most
    ``most_bytes``: the sizes of cells are summed over the rows of an id as they stream by, before anything is put together.
    A longer cell says how many messages ``long_cell_messages`` has for it. ``feature_ordinal`` is the first feature in error
    under the id. ``res_exceed`` comes from the last resolution item and is set only if that item points at the same feature.
    """
    columns = {t: c for t, c, _ in K.ERROR_TYPES}
    fixed = {t: m for t, m in K.CHECKER_MESSAGES.items() if t not in _VARYING}
    is_resolution = F.col("type") == K.RESOLUTION
    size = F.octet_length("message") + len(K.MESSAGE_SEPARATOR)
    cell = Window.partitionBy(*KEYS)
    # one shuffle by id serves the sizes and the groups; rows of an id wait on disk, not in memory, while sizes are summed
    sized = errors.withColumns({f"__size_{columns[t]}": F.sum(F.when(F.col("type") == t, size)).over(cell) for t in _VARYING})
    fits = F.lit(False)
    for t in _VARYING:
        fits = fits | ((F.col("type") == t) & (F.col(f"__size_{columns[t]}") <= most_bytes))
    grouped = sized.groupBy(*KEYS).agg(
        F.min(F.struct("phase", "ordinal", "item", "feature_ordinal"))["feature_ordinal"].alias("feature_ordinal"),
        F.max(F.when(is_resolution, F.struct("phase", "ordinal", "item", "is_exceeded", "feature_ordinal"))).alias("last_res"),
        F.sort_array(F.collect_list(F.when(fits, F.struct("type", "phase", "ordinal", "item", "message")))).alias("texts"),
        *[F.count_if(F.col("type") == t).alias(f"__{c}") for t, c in columns.items()],
        *[F.max(f"__size_{columns[t]}").alias(f"__size_{columns[t]}") for t in _VARYING],
    )

    def varying(error_type: str) -> Column:
        column = columns[error_type]
        kept = F.filter("texts", lambda x: x["type"] == error_type)
        long = F.concat(F.col(f"__{column}").cast("string"), F.lit(" messages in the error table"))
        text = F.when(F.size(kept) > 0, F.array_join(F.transform(kept, lambda x: x["message"]), K.MESSAGE_SEPARATOR))
        return F.when(F.col(f"__size_{column}") > most_bytes, long).otherwise(text)

    cells = {columns[t]: varying(t) for t in _VARYING}
    cells |= {columns[t]: repeat_joined(message, F.col(f"__{columns[t]}")) for t, message in fixed.items()}
    same_feature = F.col("last_res.feature_ordinal") == F.col("feature_ordinal")
    exceeded = F.when(F.coalesce("last_res.is_exceeded", F.lit(False)), "true").otherwise("false")
    return grouped.select(
        *KEYS, "feature_ordinal", *[cells[c].alias(c) for c in K.REPORT_COLUMNS],
        F.when(same_feature, exceeded).alias("res_exceed"),
    )


def long_cell_messages(errors: DataFrame, most_bytes: int = CELL_BYTES) -> DataFrame:
    """Rows of the error table of the cells that ``errors_by_feature`` does not put together: their report, one row per message.

    Sizes are summed on the map side; rows of a cell stay spread over as many tasks as the error table has.
    """
    cell = [*KEYS, "column_name"]
    size = F.sum(F.octet_length("message") + len(K.MESSAGE_SEPARATOR))
    long = errors.filter(F.col("type").isin(*_VARYING)).groupBy(*cell).agg(size.alias("size")).filter(F.col("size") > most_bytes)
    return split_join(errors, long.select(*cell), cell, "left_semi")


def report_rows(features: DataFrame, errors: DataFrame) -> DataFrame:
    """The wide report with the attributes of each feature in error; the ``vertices`` helper attribute is left out."""
    wide = errors_by_feature(errors).withColumnRenamed("id", "error_id")
    attributes = features.drop("chunk_id", "vertices").withColumnRenamed("ordinal", "feature_ordinal")
    return wide.join(attributes, ["job_id", "feature_ordinal"])
