"""Joins in which one key of the left side may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# Rows of one key that a single task may take.
HOT_ROWS = 5_000_000


def split_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", hot_rows: int | None = None,
) -> DataFrame:
    """Join where keys with more than ``hot_rows`` left rows are spread over several tasks.

    Such a key is cut into ``ceil(rows / hot_rows)`` slices by a hash of the left row, and its right rows are repeated once
    per slice; all other keys are joined as they are. ``how`` may be inner, left, left_semi or left_anti. The list of hot
    keys is broadcast: it has at most (left rows / hot_rows) entries, a few megabytes for a trillion rows.
    """
    size = hot_rows or HOT_ROWS
    keys = list(keys)
    # a hot key is in a hot value of its first column; these are few, and are counted without moving the rows
    values = left.groupBy(keys[0]).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > size)
    suspected = left.select(*keys).join(F.broadcast(values.select(keys[0])), keys[0], "left_semi")
    counted = suspected.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > size)
    hot = F.broadcast(counted.select(*keys, F.ceil(F.col("__n") / size).alias("__slices")))
    slices = F.coalesce("__slices", F.lit(1).cast("bigint"))
    cut = left.join(hot, keys, "left").withColumn(
        "__slice", F.pmod(F.xxhash64(*left.columns), slices)
    ).drop("__slices")
    repeated = right.join(hot, keys, "left").withColumn("__slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1))).drop("__slices")
    return cut.join(repeated, [*keys, "__slice"], how).drop("__slice")
