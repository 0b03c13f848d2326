"""Whole-frame column helpers: names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entryclime.functions import text


def clean_names(df: DataFrame) -> DataFrame:
    """Column names in lower case, blanks and hyphens as ``_``."""
    return df.toDF(*text.clean_column_names(df.columns))


def strip_trailing_2(df: DataFrame) -> DataFrame:
    """Remove one trailing ``2`` from every column name."""
    return df.toDF(*[c[:-1] if c.endswith("2") else c for c in df.columns])


def cast_columns(df: DataFrame, cols: list[str], dtype: str) -> DataFrame:
    """Bulk cast in place (ANSI-safe ``try_cast``), column order kept."""
    return df.withColumns({c: F.col(c).try_cast(dtype) for c in cols})
