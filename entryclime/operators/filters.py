"""Row filters used by the cleaning jobs. All are plain predicates, so Catalyst
can push the column-only ones into the parquet scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entryclime.functions.text import ColumnOrName, _c


def any_of(preds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, preds, F.lit(False))


def starts_with_any(c: ColumnOrName, prefixes: list[str]) -> Column:
    x = _c(c)
    return any_of([x.startswith(p) for p in prefixes])


def contains_any(c: ColumnOrName, words: list[str]) -> Column:
    x = _c(c)
    return any_of([x.contains(w) for w in words])


def exclude_prefixes(df: DataFrame, col: str, prefixes: list[str]) -> DataFrame:
    """Drop rows whose ``col`` starts with any prefix (null rows are dropped too)."""
    return df.where(~starts_with_any(col, prefixes))


def exclude_containing(df: DataFrame, col: str, words: list[str], keep_nulls: bool = False) -> DataFrame:
    """Drop rows whose ``col`` contains any word; ``keep_nulls`` keeps null values."""
    hit = contains_any(col, words)
    return df.where(~F.coalesce(hit, F.lit(False)) if keep_nulls else ~hit)


def allow_deny(df: DataFrame, rule: Column, allow: Column | None = None, deny: Column | None = None) -> DataFrame:
    """Keep rows matching ``rule`` or the allow-list predicate, minus the deny-list predicate."""
    keep = rule if allow is None else (rule | allow)
    keep = F.coalesce(keep, F.lit(False))
    if deny is not None:
        keep = keep & ~F.coalesce(deny, F.lit(False))
    return df.where(keep)


def non_empty(df: DataFrame, col: str) -> DataFrame:
    """``col`` neither null nor the empty string."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def all_present(cols: list[str]) -> Column:
    """No null in ``cols``, as one condition per column."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols], F.lit(True))


def any_null(cols: list[str]) -> Column:
    return any_of([F.col(c).isNull() for c in cols])


def is_empty(col: str) -> Column:
    """``col`` null or the empty string."""
    return F.coalesce(F.col(col) == "", F.lit(True))


def drop_null_rows(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=subset)
