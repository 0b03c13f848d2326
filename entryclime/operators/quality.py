"""Row-count quality gates.

``row_counts`` builds ONE plan: a union of per-table ``count(*)`` aggregates,
so all tables are checked by a single job whose result has one row per table.
``assert_quality`` is the gate between pipeline steps; it collects only that
bounded check frame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class QualityCheckError(RuntimeError):
    pass


def row_counts(tables: dict[str, DataFrame], min_rows: int = 1) -> DataFrame:
    """``(table_name, n_rows, passed)`` with ``passed = n_rows >= min_rows``."""
    parts = [
        df.agg(F.count(F.lit(1)).cast("long").alias("n_rows"))
          .select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    union = reduce(DataFrame.unionByName, parts)
    return union.withColumn("passed", F.col("n_rows") >= F.lit(min_rows))


def duplicate_keys(df: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """Keys that occur more than once: ``(keys..., n_rows, n_versions)``.

    ``n_versions`` counts the distinct ``values`` tuples under the key: 1 means
    the repeats are exact copies (e.g. one city matched by two gazetteer points
    in the same state), more means the key really carries conflicting values.
    One grouped aggregate; lazy, so the caller decides whether to count,
    sample or write the offending keys.
    """
    vals = values or [c for c in df.columns if c not in keys]
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"),
                              F.count_distinct(F.struct(*vals)).alias("n_versions"))
    return g.where(F.col("n_rows") > 1)


def violations(df: DataFrame, name: str, bad: Column) -> DataFrame:
    """A check ``(table_name, n_rows, passed)`` that no row is ``bad``; ``n_rows`` counts those that are."""
    n = F.count_if(F.coalesce(bad, F.lit(False))).cast("long")
    return df.agg(n.alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows", (F.col("n_rows") == 0).alias("passed"))


def unique_key(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """A check that no key occurs twice; ``n_rows`` counts the keys that do."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return violations(repeated, name, F.col("_n") > 1)


def file_row_counts(spark: SparkSession, paths: dict[str, str]) -> dict[str, int]:
    """Rows of Parquet tables from their files' footers, without reading a column.

    The count is pushed into the columnar source, which the row-based file source does not do, so the counting runs in
    a session that has its own SQL settings; the caller's are not changed.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")

    def rows(path: str) -> int:
        try:
            return counted_by_footers(own, path).first()["n_rows"] or 0
        except AnalysisException as e:
            if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a partitioned table without rows has no files
                return 0
            raise

    return {name: rows(path) for name, path in paths.items()}


def counted_by_footers(session: SparkSession, path: str) -> DataFrame:
    return session.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))


def parquet_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """Tables listed at check time (not when the pipeline is defined)."""
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{n}") for n in names}


def csv_tables(spark: SparkSession, root: str, names: list[str], header: bool = True) -> dict[str, DataFrame]:
    """CSV tables; names not ending in ``.csv`` are skipped."""
    return {n: spark.read.option("header", header).csv(f"{root.rstrip('/')}/{n}")
            for n in names if n.endswith(".csv")}


def sql_tables(spark: SparkSession, names: list[str]) -> dict[str, DataFrame]:
    """Catalog tables by name."""
    return {n: spark.table(n) for n in names}


def assert_quality(checks: DataFrame) -> DataFrame:
    """Raise ``QualityCheckError`` if any check failed; else the counted checks (one row a table, run once)."""
    counted = checks.collect()
    failed = [r for r in counted if not r["passed"]]
    if failed:
        detail = ", ".join(f"{r['table_name']} ({r['n_rows']} rows)" for r in failed)
        raise QualityCheckError(f"data quality check failed: {detail}")
    return checks.sparkSession.createDataFrame(counted, checks.schema)
