"""Spark session for local runs, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Input bytes per shuffle partition. Shuffles here carry a few columns, partly aggregated, so
# a partition holds well under this.
PARTITION_BYTES = 256 * 1024 * 1024

_local_base: str | None = None


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks. On a cluster the session is given."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("revmill")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def size_shuffles(spark: SparkSession, path: str) -> int:
    """Raises the session's shuffle partitions to suit the stored size of the input, so
    that a partition fits a task's memory; adaptive execution joins those that turn out
    small. Settings that are high enough, or made without adaptive execution, stay."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if spark.conf.get("spark.sql.adaptive.enabled") != "true":
        return current
    wanted = _stored_bytes(spark, path) // PARTITION_BYTES
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(current, wanted)


def _stored_bytes(spark: SparkSession, path: str) -> int:
    """The size of a folder as it is now."""
    fs, location = file_system(spark, path)
    return fs.getContentSummary(location).getLength()


def file_system(spark: SparkSession, path: str):
    """The file system that holds a path, and the path in its terms."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is used only in local mode, where it is shared by
    definition; on a cluster a missing setting is an error.
    """
    global _local_base
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_base


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; nothing is ever written twice to it. What lies there
    is deleted when the application ends, as a result may be read until then."""
    path = f"{shared_folder(spark).rstrip('/')}/revmill/{label}-{uuid.uuid4().hex[:12]}"
    fs, location = file_system(spark, path)
    fs.deleteOnExit(location)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder, for a result that is read several
    times: it is made once, and a lost executor does not set it back."""
    path = scratch(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_table(df: DataFrame) -> None:
    """Deletes what ``cut_lineage`` wrote, once nothing reads it any more."""
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        if "/revmill/step-" in folder:
            fs, location = file_system(df.sparkSession, folder)
            fs.delete(location, True)
