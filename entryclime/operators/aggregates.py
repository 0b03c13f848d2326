"""Aggregations: audits, profiles, month-wide matrices and per-group linear fits.

Everything here is a declarative aggregate, so Spark runs a partial
(map-side) aggregate before each shuffle; hot keys are folded per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

MONTHS = list(range(1, 13))


def null_counts(df: DataFrame, cols: list[str] | None = None,
                name_col: str = "column_name", value_col: str = "null_count") -> DataFrame:
    """Null count of every column in ONE scan, returned long: (column_name, null_count)."""
    cols = cols or df.columns
    wide = df.select(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in cols])
    return wide.unpivot([], cols, name_col, value_col)


def null_histogram(df: DataFrame, col: str) -> DataFrame:
    """Rows per ``col IS NULL`` value, and distinct values of ``col`` in each (null counted as one)."""
    return df.groupBy(F.col(col).isNull().alias("is_null")).agg(
        F.count(F.lit(1)).alias("n_rows"), distinct_count_with_null(col).cast("long").alias("n_distinct"))


def share(pred: Column) -> Column:
    """Fraction of rows where ``pred`` holds (null counts as false)."""
    return F.avg(F.coalesce(pred, F.lit(False)).cast("double"))


def distinct_count_with_null(c: str) -> Column:
    """Distinct values including null as one value (pandas ``len(unique())``)."""
    return F.count_distinct(F.col(c)) + F.max(F.col(c).isNull().cast("int"))


def month_matrix(df: DataFrame, keys: list[str], month_col: str,
                 values: dict[str, Column], months: list[int] = MONTHS,
                 complete_only: bool = True) -> DataFrame:
    """One row per ``keys``; one column ``{name}_{mm}`` per value and month.

    Pivot values are given, so no extra job looks them up. Input is expected
    one row per (keys, month); ``values`` aggregates (e.g. ``max``/``sum``)
    then just pick the value. ``complete_only`` keeps rows with every month,
    like an inner merge of the monthly tables.
    """
    named = [agg.alias(name) for name, agg in values.items()]
    wide = df.groupBy(*keys).pivot(month_col, months).agg(*named)
    renames = {}
    for m in months:
        for name in values:
            src = f"{m}_{name}" if len(values) > 1 else str(m)
            renames[src] = f"{name}_{m:02d}"
    wide = wide.withColumnsRenamed(renames)
    ordered = [f"{name}_{m:02d}" for name in values for m in months]
    wide = wide.select(*keys, *ordered)
    return wide.dropna(how="any", subset=ordered) if complete_only else wide


def matrix_to_long(df: DataFrame, keys: list[str], names: list[str], month_col: str = "month",
                   months: list[int] = MONTHS) -> DataFrame:
    """Inverse of ``month_matrix``: one row per (keys, month) with a column per name."""
    rows = F.array(*[
        F.struct(F.lit(m).alias(month_col), *[F.col(f"{n}_{m:02d}").alias(n) for n in names])
        for m in months
    ])
    return df.select(*keys, F.inline(rows))


def linear_fit(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group (what a regression plot draws).

    Written with population moments and explicit null guards: a constant
    ``x`` (or ``y``) gives null slope / r2 / corr instead of an ANSI
    division error.
    """
    pts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    g = pts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.avg(x).alias("_mx"), F.avg(y).alias("_my"),
        F.var_pop(x).alias("_vx"), F.var_pop(y).alias("_vy"),
        F.covar_pop(x, y).alias("_cxy"),
    )
    vx = F.nullif(F.col("_vx"), F.lit(0.0))
    vy = F.nullif(F.col("_vy"), F.lit(0.0))
    slope = F.col("_cxy") / vx
    return g.select(
        *keys,
        F.col("n_points").cast("long").alias("n_points"),
        slope.alias("slope"),
        (F.col("_my") - slope * F.col("_mx")).alias("intercept"),
        (F.col("_cxy") * F.col("_cxy") / (vx * vy)).alias("r2"),
        (F.col("_cxy") / F.sqrt(vx * vy)).alias("corr"),
    )


def numeric_means(df: DataFrame, keys: list[str], count_col: str = "n_rows") -> DataFrame:
    """Mean of every numeric column per ``keys`` as ``avg_<column>``, and the rows (what a pivot table averages)."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in keys]
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"avg_{c}") for c in numeric], F.count(F.lit(1)).alias(count_col))


def ranked(df: DataFrame, partition: list[str], order: list[Column], rank_col: str = "rank") -> DataFrame:
    """``row_number`` within ``partition`` by ``order`` (order must be total for determinism).

    Meant for already-aggregated inputs (one row per key), so a window
    partition is bounded by the number of distinct keys, not by raw rows.
    """
    w = Window.partitionBy(*partition).orderBy(*order) if partition else Window.orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long"))


def top_n(df: DataFrame, n: int, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """Global top ``n`` rows with a rank column.

    ``orderBy().limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n`` and only those reach the final merge, so the window
    that numbers them sees ``n`` rows.
    """
    return ranked(df.orderBy(*order).limit(n), [], order, rank_col)


def top_n_share(counts: DataFrame, n: int, count_col: str, order: list[Column],
                rank_col: str = "rank", share_col: str = "top_share") -> DataFrame:
    """Top ``n`` rows of a grouped count plus the share of the total they cover.

    The total is a scalar subquery over the counts (the second and last read);
    the sum of the top rows is a window over those ``n`` rows.
    """
    top = top_n(counts, n, order, rank_col)
    total = counts.agg(F.sum(count_col)).scalar()
    return top.withColumn(share_col, F.try_divide(F.sum(count_col).over(Window.partitionBy()), total))


def top_n_by(counts: DataFrame, group: str, n: int, order: list[Column], rank_col: str = "rank") -> DataFrame:
    """Top ``n`` rows of each ``group``; every task keeps its own top ``n`` before the exchange."""
    return ranked(counts, [group], order, rank_col).where(F.col(rank_col) <= n)


#: Buckets of a distinct sketch as a power of two; its standard error is about 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_LOG2 = 12


def distinct_sketches(df: DataFrame, keys: list[str], col: str, log2: int = SKETCH_LOG2) -> DataFrame:
    """Per key a mergeable sketch of the distinct values of ``col`` (nulls excluded): ``keys..., sketch``.

    A few kilobytes a key at any number of rows. Kept per month, they answer for every range of months.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(col, log2).alias("sketch"))


def merged_distinct(sketches: DataFrame, keys: list[str], name: str = "n_distinct") -> DataFrame:
    """Estimated distinct values over all sketches of a (coarser) key, without a read of the rows."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
