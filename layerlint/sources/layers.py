"""Exported layers: versions of a package's layers, and pointers that say which version of each is the current one."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from layerlint.functions.text import layer_name

POINTERS = "package string, layer string, version string, number bigint"


def export_targets(jobs: DataFrame, packages: DataFrame) -> DataFrame:
    """Package and layer of each export job; ``error`` says which packages do not exist."""
    known = packages.select("package").distinct().withColumn("__known", F.lit(True))
    missing = F.col("__known").isNull()
    return jobs.join(known, "package", "left").select(
        "job_id", "package", layer_name(F.col("resource_id"), F.col("product_type")).alias("layer"),
        F.when(missing, F.concat(F.lit("gpkg file does not exist at "), F.col("package"))).alias("error"),
    )


def _pointers(spark: SparkSession, path: str) -> DataFrame:
    """The latest pointer of each layer: package, layer, version and number."""
    latest = F.max(F.struct("number", "version"))
    found = spark.read.schema(POINTERS).parquet(f"{path}/pointers").groupBy("package", "layer").agg(latest.alias("at"))
    return found.select("package", "layer", "at.version", "at.number")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.schema(POINTERS).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def write_export_layer(parts: DataFrame, targets: DataFrame, path: str) -> None:
    """Replace the layer of each target with its parts and leave every other layer alone.

    The parts go to a new version of their own; then one small file of pointers, which Spark commits as a whole, makes that
    version the current one of all targets at once. Until then readers see the old layers, and so they do if the write fails,
    as it does for a target with an error. A target without parts gets a pointer and no rows: it ends empty. Rows of one layer
    may go to several tasks. Of two writers of one layer at the same time, the later version name wins as a whole.
    Versions no pointer names are left to the storage's own retention.
    """
    spark = parts.sparkSession
    version = uuid.uuid4().hex
    checked = targets.withColumn("layer", F.when(F.col("error").isNotNull(), F.raise_error(F.col("error")).cast("string")).otherwise(F.col("layer")))
    checked = checked.select("job_id", F.col("package").cast("string").alias("package"), "layer").distinct()
    (
        parts.drop("package", "layer").join(checked, "job_id").withColumn("version", F.lit(version)).hint("rebalance", "package", "layer")
        .write.mode("append").partitionBy("version", "package", "layer").parquet(f"{path}/versions")
    )
    named = checked.select("package", "layer").distinct()
    if _exists(spark, f"{path}/pointers"):
        named = named.join(_pointers(spark, path).select("package", "layer", "number"), ["package", "layer"], "left")
    else:
        named = named.withColumn("number", F.lit(None).cast("bigint"))
    number = (F.coalesce("number", F.lit(-1)) + 1).cast("bigint").alias("number")
    named.select("package", "layer", F.lit(version).alias("version"), number).coalesce(1).write.mode("append").parquet(f"{path}/pointers")


def read_layers(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of all layers, with ``package`` and ``layer`` as texts. Columns that only some layers have are NULL elsewhere."""
    names = {"version", "package", "layer"}
    stored = spark.read.option("mergeSchema", "true").parquet(f"{path}/versions").schema
    declared = T.StructType([T.StructField(f.name, T.StringType() if f.name in names else f.dataType) for f in stored.fields])
    rows = spark.read.schema(declared).parquet(f"{path}/versions")
    # versions and layers are folders, so the pointers prune what is read
    return rows.join(_pointers(spark, path).select("version", "package", "layer"), ["version", "package", "layer"], "left_semi").drop("version")


def read_layer(spark: SparkSession, path: str, package: str, layer: str) -> DataFrame:
    return read_layers(spark, path).filter((F.col("package") == package) & (F.col("layer") == layer))
