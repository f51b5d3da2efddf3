"""Reports, file listings, feature files and streams."""

import json

import pytest
from pyspark.sql import functions as F

from layerlint.operators import errors, schema, verdict
from layerlint.plans.views import Tables
from layerlint.sources import features as source, reports
from layerlint.streaming import validation as live

SF = "/root/testdata/sf0.001"


def test_append_with_new_columns(spark, tmp_path):
    path = str(tmp_path / "r")
    reports.write_report(spark.createDataFrame([(1, "a", "m")], "job_id long, id string, e_metadata string"), path)
    reports.write_report(spark.createDataFrame([(1, "b", "v"), (2, "c", "v")], "job_id long, id string, e_vertices string"), path)
    report = reports.read_report(spark, path)
    assert {(r.job_id, r.id, r.e_metadata, r.e_vertices) for r in report.collect()} == {(1, "a", "m", None), (1, "b", None, "v"), (2, "c", None, "v")}
    counts = reports.report_error_counts(report).first()
    assert (counts.metadata, counts.vertices, counts.unknown) == (1, 2, 0)


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([(1, "a")], "job_id long, id string")
    for batch in ("x", "x", "y"):
        reports.write_report(rows, path, batch=batch)
    assert reports.read_report(spark, path).count() == 2


def test_four_outcomes_and_manifest(spark):
    jobs = spark.createDataFrame([(i, "Res", "Orthophoto", "1.0") for i in range(1, 5)], "job_id int, resource_id string, product_type string, version string")
    report = spark.createDataFrame([(1,), (3,), (4,), (4,)], "job_id int")
    verdicts = spark.createDataFrame([(1, True), (2, False), (3, False), (4, True)], "job_id int, has_critical_errors boolean")
    existing = spark.createDataFrame([(1, "/old.zip", 7)], "job_id int, path string, size bigint")
    outcomes = reports.finalize_reports(jobs, report, verdicts, existing)
    assert {r.job_id: r.outcome for r in outcomes.collect()} == {1: "reused", 2: "none", 3: "dropped", 4: "published"}
    assert reports.published_rows(report, outcomes).count() == 2
    rows = {r.job_id: r for r in reports.report_manifest(outcomes, jobs, "2025-01-02 03:04:05.006").collect()}
    assert set(rows) == {1, 4} and (rows[1].fileName, rows[1].path, rows[1].fileSize) == ("old.zip", "/old.zip", 7)
    row = rows[4]
    assert row.fileName == "res_orthophoto_v1.0_report_2025-01-02T03:04:05.006Z.zip"
    assert row.url == f"http://localhost:8085/downloads/validation-reports/4/{row.fileName}"
    assert row.s3_key == f"validation-reports/4/{row.fileName}"


def test_missing_files(spark):
    listing = spark.createDataFrame([(f"a/x{e}",) for e in (".shp", ".shx", ".dbf", ".prj", ".cpg")] + [("a/y.shp",), ("a/y.shx",), ("a/y.dbf",)], "path string")
    layers = spark.createDataFrame([("a/x",), ("a/y",), ("a/z",)], "base string")
    got = {r.base: r for r in source.missing_files(layers, listing).collect()}
    assert set(got) == {"a/y", "a/z"}
    assert got["a/y"].error == "Shapefile not found: a/y. Missing files: a/y.prj, a/y.cpg"
    assert len(got["a/z"].missing) == 5


def test_geojson_lines(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    good = {"id": "a", "updateDate": "01/02/2024", "sensors": "s", "sourceRes": 1, "ep90": 5, "cities": "c", "countries": None, "publishRes": 1,
            "classify": "x", "sourceName": "n", "vertices": 4}
    lines = [
        {"job_id": 1, "ordinal": 0, "type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": good},
        {"job_id": 1, "ordinal": 1, "type": "Feature", "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]},
         "properties": {k: v for k, v in {**good, "id": 5}.items() if k != "vertices"}},
        {"job_id": 1, "ordinal": 2, "type": "Feature", "geometry": None, "properties": {k: v for k, v in good.items() if k != "cities"}},
    ]
    path = tmp_path / "l.geojsonl"
    path.write_text("\n".join(map(json.dumps, lines)))
    found = source.read_features(spark, str(path), "geojsonl")
    got = schema.metadata_issues(found).orderBy("ordinal").select("vertices", F.transform("issues", lambda i: i["path"]).alias("p")).collect()
    assert [(r.vertices, r.p) for r in got] == [(4, []), (8, ["properties.id"]), (4, ["geometry", "properties.cities"])]


@pytest.fixture(scope="module")
def layer(spark, tmp_path_factory):
    t = Tables(spark, SF)
    path = str(tmp_path_factory.mktemp("layer") / "features")
    t.features.drop("geometry", "type").repartition(6).write.parquet(path)
    return t, path


def test_streamed_equals_whole(spark, layer, tmp_path):
    t, path = layer
    stored = spark.read.parquet(path)
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out, counts = str(tmp_path / "e"), str(tmp_path / "c")
    live.validate_stream(stream, out, str(tmp_path / "k1")).awaitTermination()
    whole = schema.feature_errors(stored)
    columns = ["job_id", "chunk_id", "id", "phase", "ordinal", "item", "type", "message"]
    assert sorted(spark.read.parquet(out).select(columns).collect()) == sorted(whole.select(columns).collect())
    live.running_counts_stream(stream, counts, str(tmp_path / "k2")).awaitTermination()
    expected = verdict.feature_verdicts(stored).select("job_id", "features", "vertices", "metadata")
    assert sorted(live.latest_counts(spark.read.parquet(counts)).collect()) == sorted(expected.collect())


def test_result_does_not_depend_on_partitioning(spark, layer):
    t, path = layer
    stored = spark.read.parquet(path)

    def report(n):
        frame = stored.repartition(n)
        return sorted(errors.errors_by_feature(errors.all_errors(frame, t.part_errors.repartition(n))).collect())

    assert report(1) == report(11)


def test_error_counts_of_a_stream_end_with_the_watermark(spark, tmp_path):
    source_path, out = str(tmp_path / "errors"), str(tmp_path / "out")
    rows = spark.createDataFrame(
        [(1, "Metadata", "2024-01-01 10:00:00"), (1, "Metadata", "2024-01-01 11:00:00"), (2, "Odd", "2024-01-01 12:00:00"),
         (1, "Vertices", "2024-01-05 00:00:00")], "job_id long, type string, t string",
    ).select("job_id", "type", F.col("t").cast("timestamp").alias("ts"))
    rows.write.parquet(source_path)
    stream = spark.readStream.schema(rows.schema).parquet(source_path)
    counts = live.running_error_counts(stream, watermark="1 hour")
    (counts.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "k"))
     .trigger(availableNow=True).start().awaitTermination())
    got = {r.job_id: (r.metadata, r.vertices) for r in spark.read.parquet(out).collect()}
    assert got == {1: (2, 0), 2: (0, 0)}


def test_report_ids_keep_their_zeros(spark, tmp_path):
    path = str(tmp_path / "ids")
    reports.write_report(spark.createDataFrame([("007", 1), ("a-b", 2)], "job_id string, chunk_id int"), path)
    assert sorted(r.job_id for r in reports.read_report(spark, path, job_type="string").collect()) == ["007", "a-b"]


def test_report_files_do_not_follow_the_number_of_jobs(spark, tmp_path):
    path = str(tmp_path / "many")
    rows = spark.createDataFrame([(i if i else None, f"m{i}") for i in range(300)], "job_id long, e_metadata string")
    reports.write_report(rows, path, batch="b0")
    reports.write_report(rows, path, batch="b0")
    assert len(list((tmp_path / "many").rglob("*.parquet"))) < 50
    # the repeated batch of one job replaces that job's rows only, and another batch adds to them
    reports.write_report(spark.createDataFrame([(7, "new")], "job_id long, e_metadata string"), path, batch="b0")
    reports.write_report(spark.createDataFrame([(7, "more")], "job_id long, e_metadata string"), path, batch="b1")
    found = sorted((r.job_id or 0, r.e_metadata, r.batch) for r in reports.read_report(spark, path).collect())
    assert found == sorted([(i, f"m{i}", "b0") for i in range(300) if i != 7] + [(7, "new", "b0"), (7, "more", "b1")])
