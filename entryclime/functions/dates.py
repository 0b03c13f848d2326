"""Date parsing and date windows (Column -> Column), ANSI-safe.

Every parse of raw text goes through ``try_to_date`` so dirty rows become
null instead of failing the job under Spark's default ANSI mode.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from entryclime.functions.text import ColumnOrName, _c

# Fixed values that must equal the original job's behaviour.
# SAS day numbers count days since this epoch.
SAS_EPOCH = "1960-01-01"
# Token kept verbatim in the allowed-stay column ("duration of status").
DURATION_OF_STATUS = "D/S"
# Allowed-stay filter of the monthly fact job: anchored at the start only,
# case-insensitive; MMddyyyy with years 2016-2019 / 2026-2029, or the D/S token.
STAY_PATTERN_STRICT = r"(?i)^(?:[01][0-9][0-3][0-9]20[12][6-9]|D/S)"
# Looser variant used while profiling one month.
STAY_PATTERN_LOOSE = r"(?i)^(?:[0-1][\d]+[0-4]+[\d]+[\d]+[\d]+[\d]+|D/S)"


def iso_text_to_date(c: ColumnOrName) -> Column:
    return F.try_to_date(_c(c), "yyyy-MM-dd")


def sas_to_date(c: ColumnOrName, epoch: str = SAS_EPOCH) -> Column:
    """Days since ``epoch`` (a double) -> DATE; null, NaN, 0 and days outside the calendar give null.

    Fractions are floored, as adding a fractional ``timedelta`` and taking the
    date part does.
    """
    x = _c(c).cast("double")
    first = _dt.date.fromisoformat(epoch)
    low, high = (_dt.date.min - first).days, (_dt.date.max - first).days
    days = F.when(~F.isnan(x) & (x != 0) & (x >= low) & (x < high + 1), F.floor(x).try_cast("int"))
    return F.date_add(F.lit(first), days)


def compact_to_date(c: ColumnOrName, fmt: str = "yyyyMMdd") -> Column:
    """``'20160422'`` -> DATE; malformed text gives null."""
    return F.try_to_date(_c(c), fmt)


def strict_date(c: ColumnOrName, fmt: str) -> Column:
    """Parse ``c`` with ``fmt`` and accept it only if formatting back gives the same text."""
    x = _c(c)
    d = F.try_to_date(x, fmt)
    return F.when(F.date_format(d, fmt) == x, d)


def stay_date(c: ColumnOrName) -> Column:
    """Allowed-stay normaliser: ``MMddyyyy`` -> ``yyyy-MM-dd`` text, ``D/S`` kept, anything else null."""
    x = _c(c)
    return F.when(x == DURATION_OF_STATUS, F.lit(DURATION_OF_STATUS)).otherwise(
        F.date_format(strict_date(x, "MMddyyyy"), "yyyy-MM-dd")
    )


def stay_pattern_ok(c: ColumnOrName, pattern: str = STAY_PATTERN_STRICT) -> Column:
    """Regex gate of the fact job; null input counts as rejected."""
    return F.coalesce(_c(c).rlike(pattern), F.lit(False))


def month_token(c: ColumnOrName) -> Column:
    """DATE -> ``'apr16'``: the token in the monthly raw file names."""
    return F.lower(F.date_format(_c(c), "MMMyy"))


def year_month(c: ColumnOrName) -> Column:
    """DATE -> ``'2016-04'``."""
    return F.date_format(_c(c), "yyyy-MM")


def half_open(c: ColumnOrName, lo: str, hi: str) -> Column:
    """``lo <= c < hi`` on dates (the effective window of a string ``between``)."""
    x = _c(c)
    return (x >= F.lit(_dt.date.fromisoformat(lo))) & (x < F.lit(_dt.date.fromisoformat(hi)))
