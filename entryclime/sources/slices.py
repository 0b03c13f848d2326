"""Loads by slices of time (month, day or hour) that may be run again.

A load writes its rows as ``slice=<start>/run=<id>`` and then adds one file to the ledger, which names the finished run of
each slice. Readers take the rows of the ledger's newest run of a slice only, so

- a run that dies leaves rows that nobody reads, and can simply be run again;
- a run over the same rows changes nothing (its slices have the rows and the fingerprint that the ledger already has);
- late or corrected rows replace their slices whole, and other slices are not touched;
- a slice of the loaded range that has no rows any more becomes empty.

The fingerprint is a sum over row hashes, so it does not depend on order or partitioning. Loads of one table must not run
at the same time; the ledger's sequence numbers would tie.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entryclime.session import MAX_RECORDS_PER_FILE

GRAINS = {"month": "yyyy-MM", "day": "yyyy-MM-dd", "hour": "yyyy-MM-dd-HH"}
LEDGER = "sequence long, slice string, run string, n_rows long, fingerprint decimal(38,0)"


def slice_of(when: str | Column, grain: str) -> Column:
    """The slice of a date or time without zone, as text that sorts by time and may stand in a path."""
    c = F.col(when) if isinstance(when, str) else when
    return F.date_format(c.cast("timestamp_ntz").cast("timestamp"), GRAINS[grain])


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The finished run of every slice: ``sequence, slice, run, n_rows, fingerprint``."""
    path = f"{root.rstrip('/')}/_ledger"
    if not _exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    entries = spark.read.schema(LEDGER).parquet(path)
    rest = [c for c in entries.columns if c != "slice"]
    return entries.groupBy("slice").agg(F.max(F.struct(*rest)).alias("_e")).select(
        "_e.sequence", "slice", "_e.run", "_e.n_rows", "_e.fingerprint")


def _summary(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows and fingerprint of every slice, folded before the exchange."""
    hashed = F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in columns]).cast("decimal(38,0)")
    return rows.groupBy("slice").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(hashed).alias("fingerprint"))


def load(df: DataFrame, root: str, when: str, grain: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Replace the slices of ``df`` whose rows differ from what is loaded; returns the ledger entries written.

    ``first`` and ``last`` (slice names, inclusive) declare the range that ``df`` covers completely: finished slices in it
    without rows now become empty, and rows outside it are an error. Without them only the slices of ``df`` change. Rows
    whose time is null cannot be assigned and are an error too. ``df`` must not have columns ``slice`` or ``run``.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    if {"slice", "run"} & set(df.columns):
        raise ValueError("columns slice and run are taken by the load")
    name = slice_of(when, grain)
    outside = F.lit(False) if first is None else (name < first) | (name > last)
    checked = F.when(name.isNull() | outside, F.raise_error(F.lit("a row lies outside the loaded slices")).cast("string")
                     ).otherwise(name)
    rows = df.withColumn("slice", checked)
    done = ledger(spark, root)
    incoming = _summary(rows, df.columns)
    in_range = F.lit(False) if first is None else F.col("slice").between(first, last)
    emptied = done.where(in_range & (F.col("n_rows") > 0)).select("slice", F.lit(0).cast("long").alias("_n"))
    known = done.select(F.col("slice").alias("_slice"), F.col("n_rows").alias("_rows"), F.col("fingerprint").alias("_print"),
                        "sequence")
    next_ = F.lit((done.agg(F.max("sequence")).first()[0] or 0) + 1).cast("long")
    merged = (incoming.join(emptied, "slice", "full")
              .select("slice", F.coalesce("n_rows", "_n").alias("n_rows"),
                      F.coalesce("fingerprint", F.lit(0).cast("decimal(38,0)")).alias("fingerprint")))
    changed = (merged.join(known, F.col("slice") == F.col("_slice"), "left")
               .where(F.col("_slice").isNull() | (F.col("n_rows") != F.col("_rows"))
                      | (F.col("fingerprint") != F.col("_print"))))
    run = uuid.uuid4().hex
    plan = f"{root}/_plans/{run}"  # fixed before the rows are written, so that both see the same decision
    (changed.select(next_.alias("sequence"), "slice", F.lit(run).alias("run"), "n_rows", "fingerprint")
     .coalesce(1).write.parquet(plan))
    decided = spark.read.schema(LEDGER).parquet(plan)
    fresh = rows.join(decided.where("n_rows > 0").select("slice"), "slice", "left_semi")
    (fresh.withColumn("run", F.lit(run)).hint("rebalance", "slice").write.mode("append")
     .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).partitionBy("slice", "run").parquet(f"{root}/rows"))
    decided.coalesce(1).write.mode("append").parquet(f"{root}/_ledger")  # the commit: one file
    return decided


def read(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of all finished slices, with their ``slice``; the run folders of other runs are pruned."""
    root = root.rstrip("/")
    finished = ledger(spark, root).where("n_rows > 0").select(F.col("slice").alias("_slice"), F.col("run").alias("_run"))
    if not _exists(spark, f"{root}/rows"):
        return spark.createDataFrame([], f"{schema}, slice string")
    rows = spark.read.schema(f"{schema}, slice string, run string").parquet(f"{root}/rows")
    mine = (F.col("slice") == F.col("_slice")) & (F.col("run") == F.col("_run"))
    return rows.join(finished, mine, "left_semi").drop("run")


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the folders of runs that the ledger does not name for their slice; returns how many."""
    root = root.rstrip("/")
    named = {(r["slice"], r["run"]) for r in ledger(spark, root).where("n_rows > 0").select("slice", "run").collect()}
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for status in fs.globStatus(path(f"{root}/rows/slice=*/run=*")) or []:
        folder = status.getPath()
        key = (folder.getParent().getName().split("=", 1)[1], folder.getName().split("=", 1)[1])
        if key not in named:
            fs.delete(folder, True)
            gone += 1
    return gone
