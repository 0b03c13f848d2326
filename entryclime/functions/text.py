"""String cleaning for code books and city/state text (Column -> Column).

All functions are built-in Spark expressions, so they stay inside whole-stage
codegen and are null-safe: a null input gives a null output instead of the
Python ``TypeError``/``IndexError`` a per-row helper would raise.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_quotes(c: ColumnOrName) -> Column:
    """Drop every single quote and surrounding white space (``"'ALCAN, AK'"`` -> ``ALCAN, AK``)."""
    return F.regexp_replace(F.translate(_c(c), "'", ""), r"^\s+|\s+$", "")


def collapse_spaces(c: ColumnOrName) -> Column:
    """Trim and squeeze runs of whitespace to one space."""
    return F.trim(F.regexp_replace(_c(c), r"\s+", " "))


def last_token(c: ColumnOrName) -> Column:
    """Last whitespace-separated token (the state of ``'CITY NAME ST'``)."""
    return F.substring_index(collapse_spaces(c), " ", -1)


def all_but_last_token(c: ColumnOrName) -> Column:
    """Every token but the last, joined by one space; one token gives ``''``."""
    return F.regexp_extract(collapse_spaces(c), r"^(.*) \S+$", 1)


def split_city_state(c: ColumnOrName) -> Column:
    """Struct ``(city, state)``; the city keeps one trailing space like the original split."""
    city = all_but_last_token(c)
    return F.struct(
        F.when(city == "", F.lit("")).otherwise(F.concat(city, F.lit(" "))).alias("city"),
        last_token(c).alias("state"),
    )


def state_after_comma(c: ColumnOrName) -> Column:
    """Two letters after the *first* ``', '`` when exactly two letters remain, else null."""
    col = _c(c)
    pos = F.instr(col, ", ")
    tail = col.substr(pos + 2, F.length(col))
    return F.when((pos > 0) & (F.length(tail) == 2), tail)


def city_before_comma(c: ColumnOrName) -> Column:
    """Text before the first ``', '``; the whole string when there is none."""
    return F.substring_index(_c(c), ", ", 1)


def strip_trailing_comma(c: ColumnOrName) -> Column:
    """Remove one trailing comma."""
    return F.regexp_replace(_c(c), ",$", "")


def strip_trailing_comma_or_space(c: ColumnOrName) -> Column:
    """Remove one trailing comma or one trailing space."""
    return F.regexp_replace(_c(c), "[, ]$", "")


def text_after_dash(c: ColumnOrName) -> Column:
    """Second piece of ``'X - Y'``; the string itself when there is no ``' - '``."""
    col = _c(c)
    return F.coalesce(F.get(F.split(col, " - "), 1), col)


def right_chars(c: ColumnOrName, n: int = 2) -> Column:
    """Last ``n`` characters (``'US-NY'`` -> ``'NY'``)."""
    return F.substring(_c(c), -n, n)


def first_char(c: ColumnOrName) -> Column:
    return F.substring(_c(c), 1, 1)


def inner_slice(c: ColumnOrName) -> Column:
    """Drop the first two characters and the last one (``" 'Air'"`` -> ``Air``)."""
    col = _c(c)
    return col.substr(F.lit(3), F.length(col) - 3)


def drop_first_char(c: ColumnOrName) -> Column:
    col = _c(c)
    return col.substr(F.lit(2), F.length(col))


def lower(c: ColumnOrName) -> Column:
    return F.lower(_c(c))


def clean_name(name: str) -> str:
    """Column-name normaliser: lower case, blanks and hyphens become ``_``."""
    return re.sub(r"[ -]", "_", name.lower())


def clean_column_names(names: list[str]) -> list[str]:
    return [clean_name(n) for n in names]
