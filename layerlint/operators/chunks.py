"""Vertex-bounded chunks of a layer: assignment, statistics, payloads, progress and resumption."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from layerlint.config import LIMITS, Limits
from layerlint.functions.rounding import progress_percentage
from layerlint.operators.mapping import PART_COLUMNS
from layerlint.operators.prefix import running
from layerlint.operators.schema import check_features
from layerlint.operators.verdict import CHUNK_BLOCK
from layerlint.session import written

# Features per block of the chunk assignment, and blocks folded by one task.
FEATURE_BLOCK = 65536
FAN_IN = 256


def _next_breaks(vertices: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Vertices before each feature, and where the next chunk starts if a chunk starts at that feature."""
    after = np.cumsum(vertices)
    before = after - vertices
    return before, np.searchsorted(after, before + limit, side="right")


def _block_function(vertices: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """What a block does to the open chunk: for each number of vertices in it on entry, the number on exit and chunks closed."""
    n = len(vertices)
    before, jump = _next_breaks(vertices, limit)
    total = int(vertices.sum())
    # Follow the jumps to the last chunk start of the block by doubling.
    at = np.where(jump < n, jump, np.arange(n))
    hops = (jump < n).astype(np.int64)
    while True:
        further = at[at]
        if np.array_equal(further, at):
            break
        hops = hops + hops[at]
        at = further
    carry = np.arange(limit + 1)
    first = np.searchsorted(before + vertices, limit - carry, side="right")
    broken = first < n
    start = np.minimum(first, n - 1)
    out = np.where(broken, total - before[at[start]], np.minimum(carry + total, limit))
    closed = np.where(broken, 1 + hops[start], 0)
    return out, closed


def _counted(pdf: pd.DataFrame, limit: int) -> np.ndarray:
    """Vertices that fill chunks; over-limit features fill none."""
    vertices = pdf["vertices"].fillna(0).to_numpy(dtype=np.int64)
    return np.where(vertices > limit, 0, vertices)


# Positions of a layer that one request record may hold.
PAGE_ROWS = 10_000

_FUNCTION_SCHEMA = "job_id {0}, block bigint, carry array<int>, closed array<bigint>"
_ENTRY_SCHEMA = "job_id {0}, block bigint, carry_in int, chunk_in bigint"


def _entry_states(functions: DataFrame, last_block: int, limit: int, job_type: str) -> DataFrame:
    """Vertices in the open chunk and number of closed chunks at the start of every block.

    At most ``FAN_IN`` block functions of a job are chained by one task; more blocks than that are composed into wider ones
    and resolved first, so a huge layer needs a few more small rounds, not a longer task.
    """

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        carry, chunk = (int(pdf["carry_in"].iloc[0]), int(pdf["chunk_in"].iloc[0])) if "carry_in" in pdf else (0, 0)
        states = []
        for out, closed in zip(pdf["carry"], pdf["closed"]):
            states.append((carry, chunk))
            carry, chunk = int(out[carry]), chunk + int(closed[carry])
        return pd.DataFrame({
            "job_id": pdf["job_id"].to_numpy(), "block": pdf["block"].to_numpy(),
            "carry_in": [s[0] for s in states], "chunk_in": [s[1] for s in states],
        })

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        carry, closed = np.arange(limit + 1), np.zeros(limit + 1, dtype=np.int64)
        for out, more in zip(pdf["carry"], pdf["closed"]):
            closed = closed + np.asarray(more)[carry]
            carry = np.asarray(out)[carry]
        return pd.DataFrame({
            "job_id": pdf["job_id"].iloc[:1].to_numpy(), "block": pdf["wide"].iloc[:1].to_numpy(), "carry": [carry], "closed": [closed],
        })

    entry_schema = _ENTRY_SCHEMA.format(job_type)
    if last_block < FAN_IN:
        return functions.groupBy("job_id").applyInPandas(scan, entry_schema)
    wide = functions.withColumn("wide", F.floor(F.col("block") / FAN_IN))
    composed = wide.groupBy("job_id", "wide").applyInPandas(compose, _FUNCTION_SCHEMA.format(job_type))
    entries = _entry_states(composed, last_block // FAN_IN, limit, job_type).withColumnRenamed("block", "wide")
    return wide.join(entries, ["job_id", "wide"]).groupBy("job_id", "wide").applyInPandas(scan, entry_schema)


def assign_chunks(
    features: DataFrame, limits: Limits = LIMITS, block_size: int = FEATURE_BLOCK,
) -> DataFrame:
    """Chunk of every feature: (job_id, ordinal, chunk_id), numbered from 0.

    Features are packed in order; a chunk closes when the next feature would pass the vertex limit. An over-limit feature
    joins the open chunk without filling it. Where a chunk starts depends on all features before it, so each block of a
    layer first states what it would do for every possible fill on entry, the blocks are chained, and then every block
    assigns its own features. No task holds more than one block. The first block of a job starts empty, so jobs of one block
    only take the last step. A feature without job or position fails the job.
    """
    limit = limits.max_vertices
    lost = F.raise_error(F.lit("a feature has no job or no position"))
    narrow = features.select(
        "job_id", F.when(F.col("job_id").isNull(), lost.cast("bigint")).otherwise(F.coalesce(F.col("ordinal").cast("bigint"), lost.cast("bigint"))).alias("ordinal"), "vertices",
    ).withColumn("block", F.floor(F.col("ordinal") / block_size))
    job_type = narrow.schema["job_id"].dataType.simpleString()
    last_blocks = written(narrow.groupBy("job_id").agg(F.max("block").alias("last_block")), "chunk-blocks")
    last_block = last_blocks.agg(F.max("last_block")).first()[0] or 0

    def summarise(pdf: pd.DataFrame) -> pd.DataFrame:
        carry, closed = _block_function(_counted(pdf.sort_values("ordinal"), limit), limit)
        return pd.DataFrame({
            "job_id": pdf["job_id"].iloc[:1].to_numpy(), "block": pdf["block"].iloc[:1].to_numpy(), "carry": [carry], "closed": [closed],
        })

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ordinal")
        carry, chunk = int(pdf["carry_in"].iloc[0]), int(pdf["chunk_in"].iloc[0])
        vertices = _counted(pdf, limit)
        _, jump = _next_breaks(vertices, limit)
        starts = np.zeros(len(pdf), dtype=np.int64)
        at = int(np.searchsorted(np.cumsum(vertices), limit - carry, side="right"))
        while at < len(pdf):
            starts[at] = 1
            at = int(jump[at])
        return pd.DataFrame({
            "job_id": pdf["job_id"].to_numpy(), "ordinal": pdf["ordinal"].to_numpy(), "chunk_id": chunk + np.cumsum(starts),
        })

    out_schema = f"job_id {job_type}, ordinal bigint, chunk_id bigint"
    start = {"carry_in": F.lit(0).cast("bigint"), "chunk_in": F.lit(0).cast("bigint")}
    if last_block == 0:
        return narrow.withColumns(start).groupBy("job_id", "block").applyInPandas(assign, out_schema)
    several = narrow.join(last_blocks.filter("last_block > 0").select("job_id"), "job_id", "left_semi")
    functions = several.groupBy("job_id", "block").applyInPandas(summarise, _FUNCTION_SCHEMA.format(job_type))
    entries = _entry_states(functions, last_block, limit, job_type)
    known = narrow.join(entries, ["job_id", "block"], "left").withColumns({c: F.coalesce(F.col(c).cast("bigint"), zero) for c, zero in start.items()})
    return known.groupBy("job_id", "block").applyInPandas(assign, out_schema)


def chunk_stats(features: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Features, vertices, skipped ones and whether there is anything valid to send to the checker, per chunk."""
    within = ~F.col("skipped")
    return (
        check_features(features, limits).groupBy("job_id", "chunk_id").agg(
            F.count_if(within).alias("features"),
            F.coalesce(F.sum(F.when(within, F.col("vertices"))), F.lit(0)).cast("bigint").alias("vertices"),
            F.count_if("skipped").alias("skipped_features"),
            F.coalesce(F.sum(F.when(F.col("skipped"), F.col("vertices"))), F.lit(0)).cast("bigint").alias("skipped_vertices"),
            F.max(within & ~F.col("broken")).alias("should_validate"),
        )
    )


def chunk_payload(parts: DataFrame, jobs: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Request records per chunk with its parts in order, as JSON: pages of at most ``page_rows`` parts, numbered from 0.

    A chunk is bounded by its vertices, but parts without vertices do not fill it. A page holds the parts at so many
    positions of the layer, counted from the chunk's first one, so its rows are gathered without ordering the whole chunk.
    """
    geometry = [c for c in ("geometry",) if c in parts.columns]
    first = parts.groupBy("job_id", "chunk_id").agg(F.min("ordinal").alias("__first"))
    paged = parts.join(first, ["job_id", "chunk_id"]).withColumn("page", F.floor((F.col("ordinal") - F.col("__first")) / page_rows))
    gathered = paged.groupBy("job_id", "chunk_id", "page").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", F.struct(*geometry, F.struct(*PART_COLUMNS).alias("properties")).alias("part")))).alias("p")
    )
    request = F.struct(
        F.col("job_type").alias("jobType"), F.col("catalog_id").alias("catalogId"), F.col("resource_id").alias("productId"),
        F.col("product_type").alias("productType"), F.col("version").alias("productVersion"),
        F.transform("p", lambda x: x["part"]).alias("partsData"),
    )
    header = jobs.select("job_id", "job_type", "catalog_id", "resource_id", "product_type", "version")
    return gathered.join(header, "job_id").select("job_id", "chunk_id", "page", F.size("p").alias("parts"), F.to_json(request).alias("payload"))


def running_progress(features: DataFrame) -> DataFrame:
    """Features done after each chunk and the whole-number percentage of the job they make."""
    per_chunk = features.groupBy("job_id", "chunk_id").agg(F.count(F.lit(1)).alias("features"))
    totals = features.groupBy("job_id").agg(F.count(F.lit(1)).alias("total_features"))
    done = running(per_chunk, ["job_id"], "chunk_id", F.floor(F.col("chunk_id") / CHUNK_BLOCK), sums={"processed": "features"})
    return done.join(totals, "job_id").select(
        "job_id", "chunk_id", "processed", "total_features",
        progress_percentage(F.col("processed") * 100.0 / F.col("total_features")).alias("percentage"),
    )


def resume_features(features: DataFrame, state: DataFrame) -> DataFrame:
    """Features after the last one done; a job without state starts from its beginning."""
    done = state.select("job_id", F.col("last_processed_feature").alias("__done"))
    joined = features.join(done, "job_id", "left")
    return joined.filter(F.col("__done").isNull() | (F.col("ordinal") > F.col("__done"))).drop("__done")
