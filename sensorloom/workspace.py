"""Where intermediate tables go, and how large a broadcast may be."""

import functools
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Rows a table may have before it is no longer hinted as a broadcast side.
BROADCAST_ROWS = 100_000


def work_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; on a single machine without one, a private folder.

    Executors of a cluster would each write a private folder to their own disk, so a
    cluster must name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
    return _private_dir()


@functools.cache
def _private_dir() -> str:
    return tempfile.mkdtemp(prefix="sensorloom-")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{work_dir(spark).rstrip('/')}/sensorloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written table cuts the lineage, survives lost executors and lets several
    consumers read only the columns they need.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the application, once; needed where it is not installed there."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        _SHIPPED.add(application)
        spark.sparkContext.addPyFile(_archive())


_SHIPPED: set[str] = set()


@functools.cache
def _archive() -> str:
    """The package as a zip beside the driver, from where Spark serves it to executors."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sensorloom-"), "sensorloom_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    return path
