"""Export: parts inside regions of interest, at the resolution each region allows."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from layerlint.config import ZOOM_LEVELS, ZoomLevels
from layerlint.functions.resolution import resolution_meter
from layerlint.session import spread, written

# The quadtree's root is a square of 2 ** 15 degrees around 0, 0; its smallest cells are 2 ** -17 degrees wide, about a metre.
# Level 0 has the smallest cells, and each level halves the number of cells per side.
DEPTH = 32
FINEST = -17
# Cells of one size that a box is covered by at most, before whole quads of them become the cell above.
MOST_CELLS = 16
# Pairs of a part and a region in the same cell that one task compares, about.
TASK_PAIRS = 1 << 22


def roi_feature_ids(roi: DataFrame, keys: tuple[str, ...], random: bool = False) -> DataFrame:
    """Give every region a fresh ``roi_id``, replacing any it has.

    The id is a hash of the region's keys, so a retried task names it the same; keys must tell all regions of all jobs apart. ``random`` gives UUIDs instead: write the
    result before using it twice.
    """
    fresh = F.uuid() if random else F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]), 256)
    return roi.withColumn("roi_id", fresh)


# The expressions below are SQL text: there are many, and text is parsed at once instead of being built call by call.


def _index(position: str, level: str) -> str:
    """Which cell along one side a coordinate lies in; half of it, rounded down, is the cell above."""
    return f"cast(floor(({position} + {2.0 ** (DEPTH + FINEST - 1)}D) / power(2D, {level} + {FINEST})) as bigint)"


def _touched(level: str) -> str:
    """How many cells of a level the piece touches."""
    return f"({_index('px1', level)} - {_index('px0', level)} + 1) * ({_index('y1', level)} - {_index('y0', level)} + 1)"


def box_pieces(boxes: DataFrame) -> DataFrame:
    """Boxes that cross the antimeridian (x0 > x1) cut in two, with ``piece`` 0 and 1; all others as they are, piece 0.

    A box with y0 > y1, or one that reaches beyond the root of the quadtree, fails the job. Boxes with a NULL side have no piece.
    """
    said = "concat_ws(' ', x0, y0, x1, y1)"
    piece = f"""case when y0 > y1 then cast(raise_error(concat('box has its lower side above its upper side: ', {said})) as int)
        when greatest(abs(x0), abs(y0), abs(x1), abs(y1)) >= {2.0 ** (DEPTH + FINEST - 1)}D then cast(raise_error(concat('box is outside the grid: ', {said})) as int) else 0 end"""
    pieces = f"""case when x0 > x1 then array(struct({piece} as piece, x0 as px0, 180D as px1), struct(1 as piece, -180D as px0, x1 as px1))
        else array(struct({piece} as piece, x0 as px0, x1 as px1)) end"""
    return boxes.filter("x0 is not null and y0 is not null and x1 is not null and y1 is not null").selectExpr("*", f"inline({pieces})")


def _once(rows: DataFrame, **columns: str) -> DataFrame:
    """Columns that are computed once per row however often later ones use them: a generator is not merged into what is above it."""
    listed = ", ".join(f"{text} as {name}" for name, text in columns.items())
    return rows.selectExpr("*", f"inline(array(struct({listed})))")


def box_cover(boxes: DataFrame) -> DataFrame:
    """One row per quadtree cell of each piece's cover: ``level``, ``cx`` and ``cy``.

    A piece is covered by cells of the finest level at which at most ``MOST_CELLS`` touch it; four that make up a whole cell
    above become that cell. So a long strip gets a row of small cells and not the one huge cell that holds it.
    """
    # a finer cell would be touched too often whatever its place; one eight times as wide is not: 2 * 15 / 8 + 16 / 64 + 4 < 16
    longest = f"greatest((px1 - px0) / {MOST_CELLS - 1}, (y1 - y0) / {MOST_CELLS - 1}, sqrt((px1 - px0) * (y1 - y0) / {MOST_CELLS}), {2.0**FINEST}D)"
    rows = _once(boxes, __start=f"cast(least(floor(log2({longest})) - {FINEST}, {DEPTH}) as int)")
    tried = " ".join(f"when {_touched(f'(__start + {step})')} <= {MOST_CELLS} then __start + {step}" for step in range(6))
    rows = _once(rows, __at=f"case {tried} end")
    sides = {"left": "px0", "right": "px1", "low": "y0", "top": "y1"}
    rows = _once(rows, **{f"__{n}": _index(side, "__at") for n, side in sides.items()})
    # the cells above that are whole: their numbers run from half of the first one, rounded up, to half of the one after the last
    rows = _once(rows, **{f"__w{n}": f"shiftright(__{n} + 1, 1) - {0 if n in ('left', 'low') else 1}" for n in sides})

    def cells(level: str, w: str) -> str:
        return f"""flatten(transform(sequence(__{w}left, __{w}right), x -> transform(sequence(__{w}low, __{w}top),
            y -> struct({level} as level, x as cx, y as cy))))"""

    outside = "not (shiftright(c.cx, 1) between __wleft and __wright and shiftright(c.cy, 1) between __wlow and __wtop)"
    cover = f"""case when __wleft <= __wright and __wlow <= __wtop then concat({cells('__at + 1', 'w')}, filter({cells('__at', '')}, c -> {outside}))
        else {cells('__at', '')} end"""
    return rows.selectExpr(*[f"`{c}`" for c in boxes.columns], f"inline({cover})")


def _listed(cover: DataFrame, live: list[int]) -> DataFrame:
    """Each cell at its own level, and the cells above it at those levels at which the other side has cells."""
    above = ", ".join(map(str, live))
    rows = cover.selectExpr("*", f"explode(concat(array(level), filter(cast(array({above}) as array<int>), x -> x > level))) as __at")
    return rows.selectExpr("*", "shiftright(cx, __at - level) as __cx", "shiftright(cy, __at - level) as __cy")


def _dealt(ours: DataFrame, theirs: DataFrame, cell: list[str], task_pairs: int | None = None) -> DataFrame:
    """Both sides joined by cell, in tasks of about ``task_pairs`` pairs: parts of a cell with more are cut by a hash and its regions repeated."""
    most = task_pairs or TASK_PAIRS
    counts = ours.groupBy(*cell).agg(F.count(F.lit(1)).alias("__n")).join(theirs.groupBy(*cell).agg(F.count(F.lit(1)).alias("__m")), cell)
    sizes = written(counts.select(*cell, (F.col("__n") * F.col("__m")).alias("__pairs")), "cell-pairs")
    pairs = sizes.agg(F.sum(F.col("__pairs").cast("double"))).first()[0] or 0
    tasks = max(ours.sparkSession.sparkContext.defaultParallelism, math.ceil(pairs / most))
    hot = sizes.filter(F.col("__pairs") > most).select(*cell, F.ceil(F.col("__pairs") / most).alias("__slices"))
    slices = F.coalesce("__slices", F.lit(1).cast("bigint"))
    cut = ours.join(hot, cell, "left").withColumn("__slice", F.pmod(F.xxhash64(*ours.columns), slices)).drop("__slices")
    repeated = theirs.join(hot, cell, "left").withColumn("__slice", F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1))).drop("__slices")
    by = [*cell, "__slice"]
    return cut.repartition(tasks, *by).join(repeated.repartition(tasks, *by), by).drop("__slice")


def roi_candidates(parts: DataFrame, roi: DataFrame, keys: Sequence[str], clip: bool = True) -> DataFrame:
    """Parts whose envelope meets a region's envelope, tagged with its ``roi_id``.

    ``keys`` are columns of both sides, as a job or a layer, that a part and a region must share. Boxes with x0 > x1 cross the
    antimeridian. With ``clip`` there is a row per pair and piece of the overlap, with its sides; otherwise a row per pair.

    Both sides are covered by a bounded number of quadtree cells of mixed sizes. Two cells either share no inner point or one
    holds the other, so a pair is found where the larger one is one of those above the smaller one: each cell is listed at its
    own level and at the larger levels of the other side, and an equality join finds the pairs. A pair that meets in several
    cells is kept in those that hold the lower left corner of the overlap, of which there is one on each side.

    The pairs may grow with the product of both sides, whatever the size of the files. So pairs are counted per cell first: there
    are as many tasks as pairs call for, and the parts of a cell with more than ``TASK_PAIRS`` pairs go to several of them.
    """
    box = ("x0", "y0", "x1", "y1")
    ours = written(box_cover(box_pieces(spread(parts).withColumns({c: F.col(c).cast("double") for c in box}))), "part-cells")
    theirs = written(box_cover(box_pieces(spread(roi).selectExpr("roi_id", *keys, *[f"cast({c} as double) as {c}" for c in box]))), "region-cells")
    # bounded by the depth of the tree
    live = ours.selectExpr("0 as side", "level").union(theirs.selectExpr("1 as side", "level")).distinct().collect()
    our_levels, their_levels = (sorted(r.level for r in live if r.side == side) for side in (0, 1))
    theirs = _listed(theirs, our_levels).selectExpr(*keys, "__at", "__cx", "__cy", "roi_id", *[f"{c} as r_{c}" for c in (*box, "px0", "px1", "piece", "level", "cx", "cy")])
    x, y = "greatest(px0, r_px0)", "greatest(y0, r_y0)"
    corner = " and ".join(f"{_index(at, f'{side}level')} = {side}{c}" for side in ("", "r_") for at, c in ((x, "cx"), (y, "cy")))
    met = _dealt(_listed(ours, their_levels), theirs, [*keys, "__at", "__cx", "__cy"]).filter(
        f"__at = greatest(level, r_level) and px0 <= r_px1 and r_px0 <= px1 and y0 <= r_y1 and r_y0 <= y1 and {corner}"
    )
    if clip:
        met = met.withColumns({"x0": F.expr(x), "y0": F.expr(y), "x1": F.least("px1", "r_px1"), "y1": F.least("y1", "r_y1")})
    else:
        met = met.filter(f"not ({_met_before()})")
    return met.select(*parts.columns, F.col("roi_id").alias("request_feature_id"))


def _met_before() -> str:
    """Whether an earlier pair of pieces of the same two boxes meets as well."""

    def sides(side: str, piece: int) -> tuple[str, str]:
        x0, x1 = f"{side}x0", f"{side}x1"
        return (x0, f"if({x0} > {x1}, 180D, {x1})") if piece == 0 else ("-180D", f"if({x0} > {x1}, {x1}, null)")

    met = []
    for a, b in ((0, 0), (0, 1), (1, 0)):
        (a0, a1), (b0, b1) = sides("", a), sides("r_", b)
        met.append(f"coalesce((piece > {a} or piece = {a} and r_piece > {b}) and {a0} <= {b1} and {b0} <= {a1}, false)")
    return " or ".join(met)


def apply_roi_resolution(
    candidates: DataFrame, roi: DataFrame, zoom_levels: ZoomLevels = ZOOM_LEVELS, fail: bool = True,
) -> DataFrame:
    """Raise each part's resolution to its region's limit, recompute metres, drop the request id.

    A part whose region is unknown or has no limit fails the job; with ``fail=False`` such parts keep a NULL
    ``resolution_meter`` and carry the text in ``error`` instead.
    """
    # a repeated id would repeat parts
    twice = F.raise_error(F.concat(F.lit("region id is not unique: "), F.col("roi_id"))).cast("double")
    limits = roi.groupBy("roi_id").agg(F.count(F.lit(1)).alias("n"), F.first("max_resolution_deg").alias("limit")).select(
        F.col("roi_id").alias("request_feature_id"), F.when(F.col("n") > 1, twice).otherwise(F.col("limit")).alias("__limit")
    )
    joined = candidates.join(limits, "request_feature_id", "left")
    message = F.concat(
        F.lit("Feature: "), F.coalesce("request_feature_id", F.lit("undefined")), F.lit(" doesnt have set maxResolutionDegree")
    )
    missing = F.col("__limit").isNull()
    degree = F.when(~missing, F.greatest("resolution_degree", "__limit"))
    if fail:
        degree = F.when(missing, F.raise_error(message).cast("double")).otherwise(degree)
    kept = [c for c in candidates.columns if c not in ("request_feature_id", "resolution_degree", "resolution_meter")]
    result = joined.withColumn("__degree", degree).select(
        *kept, F.col("__degree").alias("resolution_degree"), resolution_meter(F.col("__degree"), zoom_levels).alias("resolution_meter"),
        *([] if fail else [F.when(missing, message).alias("error")]),
    )
    return result
