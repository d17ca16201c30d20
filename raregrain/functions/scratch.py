"""Intermediate tables in the shared checkpoint folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset a local-mode session gets a temporary folder; a cluster
    must name a shared one.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="raregrain-")
    return _LOCAL["dir"]


def scratch_path(spark: SparkSession) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/raregrain-{uuid.uuid4().hex}"


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    """Let the file system drop an intermediate folder when the driver's JVM ends."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)


def materialise(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write a frame once and read it back: short lineage, column pruning and size statistics.

    Unlike a cache it survives the loss of executors.
    """
    path = scratch_path(df.sparkSession)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    _remove_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself if it only reads files, else a stored copy: for frames that a plan uses more than once."""
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.children().size() == 1 and plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return df if plan.nodeName() == "LogicalRelation" else materialise(df)
