"""Shards of near equal bytes as the leaves of a k-d tree over document metadata."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from layerlint.session import prepare, written

BINS = 1024
SLOT_ROWS = 50_000  # rows numbered together


@dataclass
class Node:
    """A cell of the tree: a leaf (no child), or a split of rows whose (coordinate, tie) is below (value, tie) from the rest.

    The two parts of a split are at ``child`` and ``child + 1`` of the list that holds the tree.
    """

    leaves: int
    first: int
    dimension: str = "__d_source"
    value: float = 0.0
    tie: float = 0.0
    child: int = -1


def _unit(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary")) / F.lit(float(2**32))


def with_metadata(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds ``__size`` (UTF-8 bytes plus 16), ``__crc`` and the coordinates, all in [0, 1): source, language, logarithm of the
    size, and key over the range of a signed 64-bit number's logarithm. ``__tie`` orders equal coordinates. Nulls are zero."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.withColumn("__size", F.octet_length(body).cast("bigint") + 16).withColumn("__crc", F.crc32(body))
    number = F.coalesce(F.col(key).cast("double"), F.lit(0.0))
    return rows.withColumns({
        "__d_source": _unit(F.col("source")), "__d_lang": _unit(F.col("lang")), "__d_size": F.log2(F.col("__size").cast("double")) / 64,
        "__d_key": F.signum(number) * F.log2(F.abs(number) + 1) / 128 + 0.5,
        "__tie": F.shiftrightunsigned(F.xxhash64(F.col(key), "__crc", "__size"), 11) / F.lit(float(2**53)),
    })


DIMENSIONS = ("__d_source", "__d_lang", "__d_size", "__d_key")


def _cell(tree: list[Node]) -> Column:
    """The number of the cell that a row falls into: a walk down the tree, a step per level."""
    left = F.lit([n.child for n in tree])
    value, tie = F.lit([float(n.value) for n in tree]), F.lit([float(n.tie) for n in tree])
    on = F.lit([DIMENSIONS.index(n.dimension) + 1 for n in tree])
    coordinates = F.array(*DIMENSIONS)

    def step(at: Column, _: Column) -> Column:
        i = at + 1
        x = F.element_at(coordinates, F.element_at(on, i))
        below = (x < F.element_at(value, i)) | ((x == F.element_at(value, i)) & (F.col("__tie") < F.element_at(tie, i)))
        return F.when(F.element_at(left, i) < 0, at).otherwise(F.element_at(left, i) + F.when(below, 0).otherwise(1))

    depth = max(1, math.ceil(math.log2(max(n.leaves for n in tree))) + 1)
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), F.lit(0), step)


def _shard(tree: list[Node]) -> Column:
    return F.element_at(F.lit([n.first for n in tree]), _cell(tree) + 1)


def kd_tree(meta: DataFrame, shards: int) -> list[Node]:
    """The tree with ``shards`` leaves.

    All cells of a level are split together. A cell of k leaves is cut along its widest coordinate where floor(k / 2) / k of
    its bytes lie below. The cut is found in histograms of ``BINS`` bins per cell, each round inside the bin that the last one
    left, first over the coordinate and then over the tie of equal coordinates, until the bin holds a thousandth of a leaf or
    one row. What comes to the driver is bounded by cells times bins, whatever the number of rows.
    """
    tree = [Node(shards, 0)]
    frontier = [0]
    while frontier := [i for i in frontier if tree[i].leaves > 1]:
        rows = meta.withColumn("__cell", _cell(tree)).filter(F.col("__cell").isin(frontier))
        stats = {r["__cell"]: r for r in rows.groupBy("__cell").agg(
            F.sum("__size").alias("bytes"), *[f(d).alias(f"{g}{d}") for d in DIMENSIONS for f, g in ((F.min, "low"), (F.max, "high"))]).collect()}
        search = {}
        for i in frontier:
            node = tree[i]
            left = node.leaves // 2
            if (s := stats.get(i)) is None:  # no rows: any cut will do
                continue
            node.dimension = max(DIMENSIONS, key=lambda d: s[f"high{d}"] - s[f"low{d}"])
            search[i] = {"on": node.dimension, "low": s[f"low{node.dimension}"], "high": s[f"high{node.dimension}"], "fixed": None, "below": 0, "goal": s["bytes"] * left / node.leaves, "enough": s["bytes"] / node.leaves / 1000}
        while search:
            order = list(search)
            which = F.nullif(F.array_position(F.lit(order), F.col("__cell")).cast("int"), F.lit(0))
            coordinates, names = F.array(*DIMENSIONS, "__tie"), [*DIMENSIONS, "__tie"]
            near = rows.withColumn("at", which).filter("at > 0").withColumns({
                "x": F.element_at(coordinates, F.element_at(F.lit([names.index(search[i]["on"]) + 1 for i in order]), F.col("at"))),
                "low": F.element_at(F.lit([float(search[i]["low"]) for i in order]), F.col("at")),
                "high": F.element_at(F.lit([float(search[i]["high"]) for i in order]), F.col("at")),
                # where a tie is searched, the coordinate itself is settled
                "own": F.element_at(coordinates, F.element_at(F.lit([names.index(tree[i].dimension) + 1 for i in order]), F.col("at"))),
                "settled": F.element_at(F.lit([float("nan") if search[i]["fixed"] is None else float(search[i]["fixed"]) for i in order]), F.col("at")),
            }).filter(F.col("x").between(F.col("low"), F.col("high")) & (F.isnan("settled") | (F.col("own") == F.col("settled"))))
            width = F.col("high") - F.col("low")
            place = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("low")) / width * BINS), F.lit(BINS - 1))).otherwise(0)
            bins: dict[int, list] = {}
            for r in near.groupBy("__cell", place.alias("bin")).agg(F.sum("__size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect():
                bins.setdefault(r["__cell"], []).append(r)
            for i, q in list(search.items()):
                node, below = tree[i], q["below"]
                found = sorted(bins[i], key=lambda r: r["bin"])
                for at, r in enumerate(found):
                    if below + r["bytes"] > q["goal"] or at == len(found) - 1:
                        break
                    below += r["bytes"]
                after = found[at + 1]["low"] if at + 1 < len(found) else math.nextafter(r["high"], math.inf)
                done = r["n"] == 1 or r["bytes"] <= q["enough"]
                if done or (r["low"] == r["high"] and q["fixed"] is not None):
                    cut = r["low"] if q["goal"] - below < below + r["bytes"] - q["goal"] else after
                    node.value, node.tie = (cut, 0.0) if q["fixed"] is None else (q["fixed"], cut)
                    del search[i]
                elif r["low"] == r["high"]:
                    q |= {"on": "__tie", "low": 0.0, "high": 1.0, "fixed": r["low"], "below": below}
                else:
                    q |= {"low": r["low"], "high": r["high"], "below": below}
        after = []
        for i in frontier:
            left = tree[i].leaves // 2
            tree[i].child = len(tree)
            after += [len(tree), len(tree) + 1]
            tree += [Node(left, tree[i].first), Node(tree[i].leaves - left, tree[i].first + left)]
        frontier = after
    return tree


def shard_documents(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """All rows with size, text_crc32, shard and slot (and the columns ``keep``, doc_id unless given).

    Either the number of shards is given or ``target_bytes``, which leaves hold about. Shards have near equal bytes: each cut
    is exact to a row or a thousandth of a leaf. slot numbers the rows of a shard from 0 without gaps, in blocks of a bounded
    number of rows. Nulls: a null text has size 16 and the CRC of an empty text, other nulls count as empty or 0. Rows equal
    in key, text and all coordinates cannot be told apart and share a shard; equal texts under different keys may part. Input
    columns named like an output column are replaced. An empty table gives no rows.
    """
    prepare(docs.sparkSession)
    keep = ["doc_id"] if keep is None else keep
    meta = written(with_metadata(docs).select("__size", "__tie", *DIMENSIONS), "shard-metadata")
    rows, total = meta.agg(F.count(F.lit(1)), F.sum("__size")).first()
    shards = shards or max(1, math.ceil((total or 0) / target_bytes))
    tree = kd_tree(meta, shards)
    blocks = max(1, math.ceil(rows / (shards * SLOT_ROWS)))
    placed = with_metadata(docs).withColumn("__shard", _shard(tree))
    placed = placed.withColumn("__block", F.floor(F.col("__tie") * blocks).cast("int"))
    kept = [c for c in keep if c not in ("size", "text_crc32", "shard", "slot")]
    small = placed.select(*kept, F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.col("__shard").alias("shard"), "__block", "__tie")
    at = F.row_number().over(Window.partitionBy("shard", "__block").orderBy("__tie")) - 1
    if blocks == 1:
        return small.withColumn("slot", at.cast("bigint")).drop("__block", "__tie")
    counts = meta.select(_shard(tree).alias("shard"), F.floor(F.col("__tie") * blocks).cast("int").alias("__block")).groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select("shard", "__block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before")), "shard-offsets")
    return small.withColumn("slot", at.cast("bigint")).join(offsets, ["shard", "__block"]).withColumn("slot", F.col("slot") + F.col("__before")).drop("__block", "__tie", "__before")
