"""Role mapping from the driver's star-schema tables to the travel / climate inputs.

fact         = orders joined to customer: port = customer's nation,
               entry date = order date
port         = nation (code = nation key, city = lower-cased name, state = region key)
temperature  = mean ``l_quantity`` per (supplier nation, month) from lineitem x supplier
raw text     = strings assembled from the table columns (code-book lines,
               ``'lon, lat'`` pairs, ``32.5N`` suffixes, ``MMddyyyy`` dates)

Every builder reads the given tables, so the work grows with them. The
string formulas below are fixed so that the DuckDB oracle can rebuild them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entryclime.functions import dates

# Fixed parameters of the derived columns.
STAY_SHIFT_MONTHS = 252           # moves 1995-2001 order dates into 2016-2022
CLIMATE_WINDOW = ("1996-09-01", "2000-09-01")
RECENT_AFTER = "1999-09-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def nation_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation with its region name (a fixed-size code book)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n["n_regionkey"] == r["r_regionkey"], "inner").drop("r_regionkey")


def state_code(region_name: Column) -> Column:
    """Two-letter state code of a region: first two letters, upper case."""
    return F.upper(F.substring(region_name, 1, 2))


def key_latitude(k: Column) -> Column:
    """Fixed formula: 24.5 + k mod 26 degrees north."""
    return F.lit(24.5) + (k % 26).cast("double")


def key_longitude(k: Column) -> Column:
    """Fixed formula: -(125.5 - k mod 59) degrees (west)."""
    return -(F.lit(125.5) - (k % 59).cast("double"))


def entry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row-grain fact: (o_orderkey, port, entry date, year, month) and the profile columns of both tables."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    d = F.to_date("o_orderdate")
    return j.select("o_orderkey", "o_custkey", F.col("c_nationkey").cast("long").alias("i94port_city_code"),
                    d.alias("entry_date"), F.year(d).alias("entry_year"), F.month(d).alias("entry_month"),
                    "o_orderstatus", "o_orderpriority", "c_mktsegment")


def port_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("long").alias("i94port_code"), F.lower("n_name").alias("city"),
                    F.col("n_regionkey").cast("long").alias("state_code"))


def ship_filter(lo: str | None = None, hi: str | None = None, after: str | None = None) -> Column:
    """Date window on ``l_shipdate`` written on the raw column so it reaches the parquet scan.

    The bounds are ISO text cast to a timestamp without a zone, so neither the
    session's nor the machine's time zone moves them.
    """
    c = F.col("l_shipdate")
    cond = F.lit(True)
    if lo:
        cond = cond & (c >= F.lit(lo).cast("timestamp_ntz"))
    if hi:
        cond = cond & (c < F.lit(hi).cast("timestamp_ntz"))
    if after:
        cond = cond & (c > F.lit(after).cast("timestamp_ntz"))
    return cond


def nation_temperature(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """(s_nationkey, month, sum, n) of ``l_quantity``, aggregated before the supplier join.

    lineitem is folded per (supplier, month) by a partial + final aggregate
    first; only then is the (much smaller) result joined to supplier and
    re-aggregated per nation. Averages are carried as (sum, n) so the two
    steps compose exactly.
    """
    li = table(spark, sf_dir, "lineitem")
    if where is not None:
        li = li.where(where)
    per_supp = li.groupBy("l_suppkey", F.month("l_shipdate").alias("month")).agg(
        F.sum("l_quantity").alias("_s"), F.count("l_quantity").alias("_n"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    j = per_supp.join(s, per_supp["l_suppkey"] == s["s_suppkey"], "inner")
    return j.groupBy("s_nationkey", "month").agg(F.sum("_s").alias("sum_value"), F.sum("_n").alias("n_samples"))


def temperature_dim(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """(city, state_id, month, average_temperature) keyed like the monthly temperature table."""
    t = nation_temperature(spark, sf_dir, where)
    n = port_rows(spark, sf_dir)
    j = t.join(n, t["s_nationkey"] == n["i94port_code"], "inner")
    return j.select(F.col("city"), F.col("state_code").alias("state_id"), "month",
                    (F.col("sum_value") / F.col("n_samples")).alias("average_temperature"),
                    F.col("n_samples"))


def known_temperatures(temperature: DataFrame) -> DataFrame:
    """Temperatures without the cells that the mapping leaves out: state 4, and state 3 in even months.

    The recovery of a join is measured against a table that lacks some keys.
    """
    return temperature.where((F.col("state_id") != 4) & ~((F.col("state_id") == 3) & (F.col("month") % 2 == 0)))


def stay_text(status: Column, order_date: Column) -> Column:
    """Allowed-stay text: ``D/S`` for open orders, ``MMddyyyy`` for finished ones and
    ``ddMMyyyy`` (often invalid) for the rest, dated 252 months after the order."""
    shifted = F.add_months(order_date, STAY_SHIFT_MONTHS)
    return (F.when(status == "O", F.lit(dates.DURATION_OF_STATUS))
             .when(status == "F", F.date_format(shifted, "MMddyyyy"))
             .otherwise(F.date_format(shifted, "ddMMyyyy")))


def port_code(nationkey: Column) -> Column:
    """``'P07'``-style port code of a nation key."""
    return F.concat(F.lit("P"), F.lpad(nationkey.cast("string"), 2, "0"))


def port_code_book(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Quoted ``(code, 'CITY, ST')`` lines and the ``(state_code, state_name)`` list.

    Line shapes by region: 0 plain, 1 with a ``(BPS)`` marker, 2 with an
    ``'X - '`` prefix, 3 a ``Collapsed`` junk line, 4 a foreign ``MX`` state.
    """
    nr = nation_dim(spark, sf_dir)
    st = state_code(F.col("r_name"))
    name = F.col("n_name")
    body = (F.when(F.col("n_regionkey") == 0, F.concat(name, F.lit(", "), st))
             .when(F.col("n_regionkey") == 1, F.concat(name, F.lit(", "), st, F.lit(" (BPS)")))
             .when(F.col("n_regionkey") == 2, F.concat(F.lit("X - "), name, F.lit(", "), st))
             .when(F.col("n_regionkey") == 3, F.concat(F.lit("Collapsed "), name))
             .otherwise(F.concat(name, F.lit(", MX"))))
    book = nr.select(F.concat(F.lit("'"), port_code(F.col("n_nationkey")), F.lit("'")).alias("code"),
                     F.concat(F.lit("'"), body, F.lit("'")).alias("value"))
    r = table(spark, sf_dir, "region")
    states = r.select(F.concat(F.lit("'"), state_code(F.col("r_name")), F.lit("'")).alias("state_code"),
                      F.concat(F.lit("'"), F.col("r_name"), F.lit("'")).alias("state_name"))
    return book, states
