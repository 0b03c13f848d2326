"""Shared-storage locations taken from the caller's session.

Intermediate tables and I/O round trips are written under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared, fault-tolerant location).
A session without that setting falls back to a folder beside its warehouse
tables (``spark.sql.warehouse.dir``), which every executor shares as well; a
machine-local temporary folder is never used. The caller's configuration is
only read. ``clear_scratch`` removes everything a session has written here.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"


def _configured_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY, None)
    if value:
        return value
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    return current.get() if current.isDefined() else None


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: the named checkpoint folder, else one beside the warehouse tables.

    On a cluster one of the two must be named: the default warehouse is a folder of the driver's machine.
    """
    context = spark.sparkContext
    named = _configured_dir(spark) or context.getConf().contains("spark.sql.warehouse.dir")
    if not named and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir (or spark.sql.warehouse.dir) to a folder that all executors share")
    found = _configured_dir(spark) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found


def _root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/entryclime/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared folder for one write."""
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex}"


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has written under the shared folder.

    Results returned as lazy frames read those files, so call this once they
    have been consumed (the bench and the tests do, between queries and at the end).
    """
    _delete(spark, _root(spark))


def write_stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a pipeline stage as parquet in the shared folder and return it read back.

    The hand-over between pipeline steps: durable (a lost executor re-reads
    files instead of recomputing the lineage) and columnar, and the next
    step's plan starts from a plain scan.
    """
    path = scratch_path(df.sparkSession, name)
    w = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows per written file, so that one task's output stays splittable for the next reader.
MAX_RECORDS_PER_FILE = 5_000_000
