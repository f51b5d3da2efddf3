"""Region lookup against all pairs, and the resolution limit."""

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from layerlint.operators import export
from layerlint.sources import layers

BOX = "x0 double, y0 double, x1 double, y1 double"


def boxes(rnd, n, widest):
    out = []
    for i in range(n):
        x, y, w, h = rnd.uniform(-180, 180), rnd.uniform(-90, 80), rnd.choice([0, 0.5, 1, 2, widest * rnd.random()]), rnd.choice([0, 1e-3, 1, widest * rnd.random()])
        x, y = (round(x), round(y)) if i % 3 == 0 else (x, y)
        east = x + w if x + w <= 180 else x + w - 360  # across the antimeridian
        out.append((x, y, max(east, -180), min(y + h, 90.0)))
    return [tuple(map(float, b)) for b in out]


def pieces(box):
    x0, y0, x1, y1 = box
    return [(x0, y0, x1, y1)] if x0 <= x1 else [(x0, y0, 180.0, y1), (-180.0, y0, x1, y1)]


def overlaps(a, b):
    return [
        (max(p[0], q[0]), max(p[1], q[1]), min(p[2], q[2]), min(p[3], q[3])) for p in pieces(a) for q in pieces(b)
        if p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3]
    ]


def tables(spark, parts, regions):
    p = spark.createDataFrame([(i % 2, i, *b, 0.1) for i, b in enumerate(parts)], f"job_id int, part_id int, {BOX}, resolution_degree double")
    r = spark.createDataFrame([(j % 2, str(j), *b) for j, b in enumerate(regions)], f"job_id int, roi_id string, {BOX}")
    return p, r


@pytest.mark.parametrize("widest", [0.01, 5, 300])
def test_candidates_equal_all_pairs(spark, widest):
    rnd = random.Random(int(widest * 100))
    parts, regions = boxes(rnd, 250, 4), boxes(rnd, 60, widest)
    # a third of all parts lie in one place
    parts = [(10.0, 10.0, 11.0, 11.0) if i % 3 == 0 else b for i, b in enumerate(parts)]
    p, r = tables(spark, parts, regions)
    expected = [(i % 2, i, str(j), *o) for i, a in enumerate(parts) for j, b in enumerate(regions) if i % 2 == j % 2 for o in overlaps(a, b)]
    got = export.roi_candidates(p, r, ("job_id",)).collect()
    assert sorted((x.job_id, x.part_id, x.request_feature_id, x.x0, x.y0, x.x1, x.y1) for x in got) == sorted(expected)
    whole = export.roi_candidates(p, r, ("job_id",), clip=False).collect()
    assert sorted((x.part_id, x.request_feature_id, x.x0, x.y0, x.x1, x.y1) for x in whole) == sorted({(i, j, *parts[i]) for _, i, j, *_ in expected})


def test_both_sides_across_the_antimeridian(spark):
    p, r = tables(spark, [(170.0, 0.0, -170.0, 5.0), (-180.0, 0.0, 180.0, 1.0)], [(175.0, 1.0, -175.0, 2.0), (179.0, 0.5, -179.0, 2.0)])
    got = sorted((x.part_id, x.x0, x.x1) for x in export.roi_candidates(p, r, ("job_id",)).collect())
    assert got == [(0, -180.0, -175.0), (0, 175.0, 180.0), (1, -180.0, -179.0), (1, 179.0, 180.0)]
    assert export.roi_candidates(p, r, ("job_id",), clip=False).count() == 2


def test_covers_are_bounded_and_follow_the_shape(spark):
    rnd = random.Random(4)
    rows = boxes(rnd, 300, 300) + [(-170.0, 10.0, -70.0, 10.001), (0.0, 0.0, 0.0, 0.0), (-180.0, -90.0, 180.0, 90.0), (5.0, -80.0, 5.0001, 80.0)]
    p, _ = tables(spark, rows, [])
    cover = export.box_cover(export.box_pieces(p)).select("part_id", "piece", "px0", "y0", "px1", "y1", "level", "cx", "cy").collect()
    count = {}
    for c in cover:
        count[c.part_id, c.piece] = count.get((c.part_id, c.piece), 0) + 1
        side = 2.0 ** (c.level - 17)
        x, y = c.cx * side - 2.0**14, c.cy * side - 2.0**14
        assert x <= c.px1 and c.px0 <= x + side and y <= c.y1 and c.y0 <= y + side
    assert max(count.values()) <= export.MOST_CELLS
    assert max(len({c.level for c in cover if c.part_id == i}) for i in range(304)) == 2  # large cells, and smaller ones at the rim
    strip = [c for c in cover if c.part_id == 300]
    assert len(strip) > 4 and all(2.0 ** (c.level - 17) <= 16 for c in strip)


def test_a_strip_and_many_small_regions_cost_few_rows(spark):
    small = spark.range(200_000).selectExpr("1 as job_id", "cast(id as string) as roi_id", "cast(id % 3000 * 0.1 - 150 as double) as x0", "cast(floor(id / 3000) * 0.1 as double) as y0")
    small = small.withColumn("x1", F.col("x0") + 0.0001).withColumn("y1", F.col("y0") + 0.0001)
    assert export.box_cover(export.box_pieces(small)).count() <= export.MOST_CELLS * 200_000
    strip, _ = tables(spark, [(0.0, 0.0, 0.0, 0.0), (-50.0, 3.0, 50.0, 3.001)], [])
    got = export.roi_candidates(strip, small, ("job_id",)).count()
    assert got == small.filter("x0 <= 50 and x1 >= -50 and y0 <= 3.001 and y1 >= 3").count() > 900


def test_wrong_and_missing_boxes(spark):
    p, r = tables(spark, [(0.0, 0.0, 1.0, 1.0), (0.0, 0.0, 1.0, 1.0)], [(0.0, 2.0, 1.0, 1.0)])
    with pytest.raises(PySparkException):
        export.roi_candidates(p, r, ("job_id",)).collect()
    p, r = tables(spark, [(None, 0.0, 1.0, 1.0), (0.0, 0.0, 1.0, 1.0)], [(0.0, 0.0, 1.0, 1.0), (0.0, 0.0, None, 1.0)])
    assert export.roi_candidates(p, r, ("job_id",)).count() == 0
    p, r = tables(spark, [(0.0, 0.0, 1.0, 1.0)], [(0.0, 0.0, 1.0, 20_000.0)])
    with pytest.raises(PySparkException):
        export.roi_candidates(p, r, ("job_id",)).collect()
    p, r = tables(spark, [], [])
    assert export.roi_candidates(p, r, ("job_id",)).count() == 0


def test_resolution_is_raised_and_metres_follow(spark):
    parts = spark.createDataFrame([(1, "r", 0.703125 / 4, 1.0), (2, "r", 1.40625 / 2, 1.0)],
                                  "part_id int, request_feature_id string, resolution_degree double, resolution_meter double")
    roi = spark.createDataFrame([("r", 0.703125 / 2)], "roi_id string, max_resolution_deg double")
    got = export.apply_roi_resolution(parts, roi).orderBy("part_id").collect()
    assert [(x.resolution_degree, x.resolution_meter) for x in got] == [(0.703125 / 2, 78271.52 / 2), (0.703125, 78271.52)]
    assert "request_feature_id" not in got[0].asDict()


def test_unknown_region_fails_or_is_listed(spark):
    parts = spark.createDataFrame([(1, "other", 0.5, 1.0)], "part_id int, request_feature_id string, resolution_degree double, resolution_meter double")
    roi = spark.createDataFrame([("r", 0.5)], "roi_id string, max_resolution_deg double")
    with pytest.raises(PySparkException):
        export.apply_roi_resolution(parts, roi).collect()
    assert export.apply_roi_resolution(parts, roi, fail=False).first().error == "Feature: other doesnt have set maxResolutionDegree"


def test_region_ids(spark):
    roi = spark.createDataFrame([(1, "old"), (2, "old")], "ordinal int, roi_id string")
    ids = [r.roi_id for r in export.roi_feature_ids(roi, ("ordinal",)).collect()]
    assert len(set(ids)) == 2 and "old" not in ids
    assert len({r.roi_id for r in export.roi_feature_ids(roi, ("ordinal",), random=True).collect()}) == 2


def test_layer_is_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "packages")
    jobs = spark.createDataFrame([(1, "p1", "R", "Orthophoto"), (2, "p2", "R", "Orthophoto")], "job_id int, package string, resource_id string, product_type string")
    packages = spark.createDataFrame([("p1",)], "package string")
    targets = layers.export_targets(jobs, packages)
    good = targets.filter("error is null")
    layers.write_export_layer(spark.createDataFrame([(1, 10)], "job_id int, part int"), good.withColumn("layer", F.lit("kept")), path)
    layers.write_export_layer(spark.createDataFrame([(1, 1), (1, 2)], "job_id int, part int"), good, path)
    layers.write_export_layer(spark.createDataFrame([(1, 3)], "job_id int, part int"), good, path)
    assert [r.part for r in layers.read_layer(spark, path, "p1", "R-Orthophoto_features").collect()] == [3]
    assert [r.part for r in layers.read_layer(spark, path, "p1", "kept").collect()] == [10]
    with pytest.raises(PySparkException):
        layers.write_export_layer(spark.createDataFrame([(2, 1)], "job_id int, part int"), targets, path)


def test_jobs_do_not_mix_and_wide_boxes_meet(spark):
    parts = spark.createDataFrame([(1, "p", 0.0, 0.0, 1000.0, 1000.0), (2, "q", 0.0, 0.0, 2.0, 2.0)], "job_id int, part_id string, x0 double, y0 double, x1 double, y1 double")
    roi = spark.createDataFrame([(1, 0, 1.0, 1.0, 2.0, 2.0), (2, 0, 1.0, 1.0, 2.0, 2.0)], "job_id int, ordinal int, x0 double, y0 double, x1 double, y1 double")
    regions = export.roi_feature_ids(roi, ("job_id", "ordinal"))
    found = export.roi_candidates(parts, regions, ("job_id",))
    assert sorted((r.job_id, r.part_id) for r in found.collect()) == [(1, "p"), (2, "q")]
    limited = regions.withColumn("max_resolution_deg", F.lit(0.5))
    given = found.withColumn("resolution_degree", F.lit(0.1))
    assert export.apply_roi_resolution(given, limited).count() == 2
    with pytest.raises(PySparkException):
        export.apply_roi_resolution(given, limited.union(limited)).collect()


def test_a_layer_without_parts_ends_empty(spark, tmp_path):
    path = str(tmp_path / "packages")
    targets = spark.createDataFrame([(1, "p 1", "a"), (2, "p 1", "b")], "job_id int, package string, layer string").withColumn("error", F.lit(None).cast("string"))
    layers.write_export_layer(spark.createDataFrame([(1, 10), (2, 20)], "job_id int, part int"), targets, path)
    layers.write_export_layer(spark.createDataFrame([(2, 21)], "job_id int, part int"), targets, path)
    assert [(r.layer, r.part) for r in layers.read_layers(spark, path).collect()] == [("b", 21)]
    layers.write_export_layer(spark.createDataFrame([], "job_id int, part int"), targets, path)
    assert layers.read_layers(spark, path).count() == 0


def test_a_failed_write_leaves_the_old_layer(spark, tmp_path):
    path = str(tmp_path / "packages")
    targets = spark.createDataFrame([(1, "007", "a"), (2, "007", "b")], "job_id int, package string, layer string").withColumn("error", F.lit(None).cast("string"))
    layers.write_export_layer(spark.createDataFrame([(1, 10), (2, 20)], "job_id int, part int"), targets, path)
    broken = spark.range(5).select(F.lit(1).alias("job_id"), F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.lit(99)).alias("part"))
    with pytest.raises(PySparkException):
        layers.write_export_layer(broken, targets, path)
    assert sorted((r.package, r.layer, r.part) for r in layers.read_layers(spark, path).collect()) == [("007", "a", 10), ("007", "b", 20)]
    wider = spark.createDataFrame([(1, 11, "x")], "job_id int, part int, note string")
    layers.write_export_layer(wider, targets.filter("job_id = 1"), path)
    assert sorted((r.layer, r.part, r.note) for r in layers.read_layers(spark, path).collect()) == [("a", 11, "x"), ("b", 20, None)]


def test_cells_with_many_pairs_are_dealt_to_several_tasks(spark):
    parts = spark.createDataFrame([(1 if i % 4 else 2, i) for i in range(200)], "cell int, part int")
    regions = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 7), (3, 8)], "cell int, region int")
    dealt = export._dealt(parts, regions, ["cell"], task_pairs=500)
    assert sorted(map(tuple, dealt.select("part", "region").collect())) == sorted(
        (i, r) for i in range(200) for r in (range(30) if i % 4 else [7]))
    # 4,550 pairs in one cell: no task holds nearly all of them
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 4000
