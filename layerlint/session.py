"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    # timestamps are UTC everywhere
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows sent to Python by size, so that memory does not follow the length of texts; a longer row is a batch of its own
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the library relies on; all of them may be set at run time."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python tasks can import it from any folder."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # the driver serves this file; executors fetch it
    archive = os.path.join(tempfile.mkdtemp(prefix="layerlint-"), "layerlint.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, which all executors can reach; the session must name it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("start the session with spark.checkpoint.dir set to a folder that all executors can reach")
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/layerlint/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """Rows stored in the shared folder and read back, for a small result that is looked at several times.

    Unlike a cache it outlives lost executors, and unlike recomputing it costs the work below it once.
    """
    path = new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """Rows of a scan in at least as many partitions as there are cores.

    Only a table in too few file splits is shuffled; a table with enough of them is left as it is.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows
