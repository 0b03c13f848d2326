"""Writers: partitioned parquet / CSV sinks, monthly exports, table inserts.

Writes partition only by low-cardinality columns (year, month): a third
level such as port x state produces many tiny files. Before a partitioned
write the rows are rebalanced on the partition columns (the ``rebalance``
hint): under AQE small partitions are coalesced and a month holding a third
of all rows is split over several tasks, so every folder gets a few sizeable
files instead of one file per (task, month). Spark's writer sorts rows by the
partition columns inside each task, so every task keeps one open file at a
time; ``max_records_per_file`` bounds file size.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from entryclime.session import MAX_RECORDS_PER_FILE, scratch_path, write_stage


def rebalanced(df: DataFrame, partition_by: list[str] | None) -> DataFrame:
    """``df`` rebalanced on ``partition_by`` (AQE splits skewed and merges small partitions)."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite", dynamic: bool = False,
                  max_records_per_file: int = MAX_RECORDS_PER_FILE) -> str:
    """Parquet sink; ``dynamic`` replaces only the partitions present in ``df``."""
    w = rebalanced(df, partition_by).write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, partition_by: list[str] | None = None, header: bool = True,
              sep: str = ",", mode: str = "overwrite") -> str:
    """CSV sink without an index column; one folder per partition value."""
    w = rebalanced(df, partition_by).write.mode(mode).option("header", header).option("sep", sep)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)
    return path


def write_monthly_csv(df: DataFrame, path: str, month_col: str, order: list[Column],
                      template: str = "{month}.csv", index_col: str = "index") -> str:
    """One headed CSV per month, named after it, in ``order`` with a row index from 0.

    For aggregated tables (a month's rows are one row per port): a month is
    sorted in one task. The files are renamed by the driver, one per month.
    """
    by_month = Window.partitionBy(month_col).orderBy(*order)
    indexed = df.withColumn(index_col, F.row_number().over(by_month) - 1)
    columns = [month_col, index_col, *[c for c in df.columns if c != month_col]]
    (indexed.select(columns).repartition(month_col).sortWithinPartitions(month_col, index_col)
     .write.mode("overwrite").option("header", True).partitionBy(month_col).csv(path))
    spark = df.sparkSession
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = hadoop_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for part in fs.globStatus(hadoop_path(f"{path}/{month_col}=*/*.csv")):
        month = part.getPath().getParent().getName().split("=", 1)[1]
        if not fs.rename(part.getPath(), hadoop_path(f"{path}/{template.format(month=month)}")):
            raise OSError(f"{part.getPath()} could not be named after its month (more than one file?)")
        fs.delete(part.getPath().getParent(), True)
    return path


def write_ordered_csv(df: DataFrame, path: str, month_col: str, order: list[Column], index_col: str = "index",
                      parts: int | None = None) -> str:
    """CSV of any size, ordered and numbered per month: ``<month_col>=<month>/part=<k>/*.csv``, parts in order.

    Rows are exchanged once, by ranges of (month, ``order``), so a month that holds most rows is spread over many tasks.
    Each range is sorted apart and its rows numbered from its offset in the month, which follows from the counts per month
    and range (at most months plus ranges rows, so their broadcast is small). The index runs from 0 without gaps. With
    ties in ``order`` rows of one rank are numbered in no particular order.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, F.col(month_col), *order).sortWithinPartitions(F.col(month_col), *order)
    rows = write_stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "ordered_rows")
    range_ = F.shiftright("_at", 33)
    counts = rows.groupBy(F.col(month_col).alias("_month"), range_.alias("_range")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    by_range = Window.partitionBy("_month").orderBy("_range")
    offsets = counts.select("_month", "_range", "_first", (F.row_number().over(by_range) - 1).alias("_part"),
                            (F.sum("_n").over(by_range) - F.col("_n")).alias("_before"))
    placed = rows.join(F.broadcast(offsets), rows[month_col].eqNullSafe(F.col("_month")) & (range_ == F.col("_range")))
    numbered = placed.select(
        month_col, (F.col("_before") + F.col("_at") - F.col("_first")).alias(index_col),
        *[c for c in df.columns if c != month_col], F.lpad(F.col("_part").cast("string"), 6, "0").alias("part"))
    (numbered.write.mode("overwrite").option("header", True).partitionBy(month_col, "part").csv(path))
    return path


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], partition_by: list[str] | None = None) -> dict:
    """Parquet sink that evaluates the aggregates ``metrics`` over the rows while it writes them; returns their values.

    No second read. Rows of a stage that Spark runs again after losing an executor are seen again, so use the figures
    for reports and ``quality.file_row_counts`` for gates.
    """
    observation = Observation()
    write_parquet(df.observe(observation, *[c.alias(name) for name, c in metrics.items()]), path, partition_by)
    return observation.get


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One-string-column frame -> text lines (used for code-book style files)."""
    df.write.mode(mode).text(path)
    return path


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def create_table(spark: SparkSession, name: str, ddl: str, location: str,
                 partition_by: list[str] | None = None) -> str:
    """External parquet table at a shared location (no metastore data is copied)."""
    parts = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet{parts} LOCATION '{location}'")
    return name


@contextmanager
def temporary_table(spark: SparkSession, prefix: str, ddl: str, partition_by: list[str] | None = None) -> Iterator[str]:
    """An external table of a unique name in the shared folder; its catalog entry goes at the end, its files stay."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    create_table(spark, name, ddl, scratch_path(spark, name), partition_by)
    try:
        yield name
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def insert(df: DataFrame, table: str, partition_by: list[str] | None = None, overwrite: bool = False) -> None:
    """Insert rows into a catalog table (the fact / dimension load step); columns in the table's order."""
    rebalanced(df, partition_by).write.insertInto(table, overwrite=overwrite)


def read_back(spark: SparkSession, table: str) -> DataFrame:
    """The files of an external table, so the rows stay readable after its catalog entry is gone."""
    info = spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Location'").first()
    return spark.read.schema(spark.table(table).schema).parquet(info["data_type"])
