"""Ordered numbering and running values that do not put a whole key into one task.

A window over ``PARTITION BY key ORDER BY position`` runs each key in one task, and one key may hold a third of all rows.
Here each key is cut into blocks along its order. Blocks are worked on in parallel; only one row per block is carried
across them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_BLOCK = "__block"


def number_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column, name: str = "ordinal") -> DataFrame:
    """0-based position of each row inside its key. ``block`` must not decrease along ``order`` and must not be NULL."""
    keyed = rows.withColumn(_BLOCK, block)
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*keys, _BLOCK).agg(F.count(F.lit(1)).alias("__rows"))
        .select(*keys, _BLOCK, F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))
    )
    inside = Window.partitionBy(*keys, _BLOCK).orderBy(*order)
    return (
        keyed.withColumn("__row", F.row_number().over(inside))
        .join(offsets, [*keys, _BLOCK])
        .withColumn(name, F.col("__before") + F.col("__row") - 1)
        .drop(_BLOCK, "__row", "__before")
    )


def running(
    rows: DataFrame,
    keys: Sequence[str],
    order: str,
    block: Column,
    sums: dict[str, str] | None = None,
    maxima: dict[str, str] | None = None,
) -> DataFrame:
    """Running sums and maxima along ``order`` (unique inside a key), as ``{new column: source column}``."""
    sums, maxima = sums or {}, maxima or {}
    # One shuffle by key and block serves both the rows and the block totals: the block is computed from ``order`` above it,
    # so both sides read the same columns and the engine reuses the exchange.
    # A block that cannot be NULL keeps the join from adding a filter to one side only.
    block = F.coalesce(block, F.lit(0))
    keyed = rows.repartition(*[F.col(k) for k in keys], block).withColumn(_BLOCK, block)
    until_here = Window.partitionBy(*keys, _BLOCK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy(*keys, _BLOCK).agg(
        *[F.sum(source).alias(f"__t_{name}") for name, source in sums.items()],
        *[F.max(source).alias(f"__t_{name}") for name, source in maxima.items()],
    )
    carried = totals.select(
        *keys, _BLOCK,
        *[F.sum(f"__t_{name}").over(earlier).alias(f"__c_{name}") for name in sums],
        *[F.max(f"__t_{name}").over(earlier).alias(f"__c_{name}") for name in maxima],
    )
    inside = keyed.withColumns(
        {f"__w_{name}": F.sum(source).over(until_here) for name, source in sums.items()}
        | {f"__w_{name}": F.max(source).over(until_here) for name, source in maxima.items()}
    )
    joined = inside.join(carried, [*keys, _BLOCK])
    return joined.withColumns(
        {name: F.coalesce(F.col(f"__c_{name}"), F.lit(0)) + F.col(f"__w_{name}") for name in sums}
        | {name: F.greatest(f"__c_{name}", f"__w_{name}") for name in maxima}
    ).drop(_BLOCK, *[f"__{p}_{name}" for name in [*sums, *maxima] for p in "wc"])
