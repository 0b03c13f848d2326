"""Registered queries over the driver's tables (one per inventory item group).

Each query is ``(spark, sf_dir) -> DataFrame`` and runs on whole tables.
Integer outputs are ``bigint``, averages and ratios are rounded to 6 places,
dates are ``date`` -- the same conventions as the SQL in ``oracle.py``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from entryclime.functions import dates, geo, text
from entryclime.operators import aggregates as agg
from entryclime.operators import filters, joins, quality, shape
from entryclime.operators.dedup import apply_overrides, distinct_rows, first_per_key
from entryclime.plans import fixtures as fx
from entryclime.plans import jobs
from entryclime.session import scratch_path, write_stage
from entryclime.sources import readers, releases, slices, writers

Query = Callable[[SparkSession, str], DataFrame]
ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _r6(c: str | Column) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _long(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


# ------------------------------------------------------------ flagship (M9)
def analytical_rows(spark: SparkSession, d: str) -> DataFrame:
    fact = fx.entry_rows(spark, d)
    return jobs.analytical_table(fact, fx.port_rows(spark, d), fx.temperature_dim(spark, d))


def analytical_table(spark: SparkSession, d: str) -> DataFrame:
    a = analytical_rows(spark, d)
    return a.select(_long("i94port_city_code").alias("i94port_city_code"), "city",
                    _long("state_code").alias("state_code"), _r6("average_temperature").alias("average_temperature"),
                    _long("entry_year").alias("entry_year"), _long("entry_month").alias("entry_month"),
                    _long("count").alias("count"), _long("rank").alias("rank"))


# ---------------------------------------------------------- climate (E1, E2)
def _nation_climate(spark: SparkSession, d: str, where: Column) -> DataFrame:
    t = fx.nation_temperature(spark, d, where)
    n = fx.table(spark, d, "nation")
    j = t.join(n, t["s_nationkey"] == n["n_nationkey"])
    return j.select(F.col("n_name").alias("city"), _long("n_regionkey").alias("state_id"),
                    _long("month").alias("month"),
                    _r6(F.col("sum_value") / F.col("n_samples")).alias("average_temperature"),
                    _long("n_samples").alias("n_samples"))


def climatology(spark: SparkSession, d: str) -> DataFrame:
    return _nation_climate(spark, d, fx.ship_filter(*fx.CLIMATE_WINDOW))


def recent_window_mean(spark: SparkSession, d: str) -> DataFrame:
    return _nation_climate(spark, d, fx.ship_filter(after=fx.RECENT_AFTER))


# ------------------------------------------------- matrix, series, fit (M10)
MATRIX_KEYS = ["i94port_city_code", "city", "state_code", "entry_year"]


def _matrix(spark: SparkSession, d: str) -> DataFrame:
    a = analytical_rows(spark, d).withColumn("average_temperature", _r6("average_temperature"))
    return jobs.port_month_matrix(a, MATRIX_KEYS)


def month_matrix(spark: SparkSession, d: str) -> DataFrame:
    m = _matrix(spark, d)
    return m.select(*[_long(k).alias(k) if k != "city" else F.col(k) for k in MATRIX_KEYS],
                    *[F.col(c) if c.startswith("average") else _long(c).alias(c)
                      for c in m.columns if c not in MATRIX_KEYS])


def matrix_to_series(spark: SparkSession, d: str) -> DataFrame:
    s = jobs.port_series(_matrix(spark, d), MATRIX_KEYS)
    return s.select(*[_long(k).alias(k) if k != "city" else F.col(k) for k in MATRIX_KEYS],
                    _long("entry_month").alias("entry_month"), "average_temperature",
                    _long("count").alias("count"))


def port_regression(spark: SparkSession, d: str) -> DataFrame:
    a = analytical_rows(spark, d).withColumn("average_temperature", _r6("average_temperature"))
    s = jobs.complete_series(a, MATRIX_KEYS)
    f = jobs.port_regression(s.withColumn("count", F.col("count").cast("double")), ["i94port_city_code"])
    return f.select(_long("i94port_city_code").alias("i94port_city_code"), "n_points",
                    *[_r6(c).alias(c) for c in ("slope", "intercept", "r2", "corr")])


# --------------------------------------------------------------- geo (D2, I*)
def geo_join(spark: SparkSession, d: str) -> DataFrame:
    c = fx.table(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("c_nation"),
        fx.key_latitude(F.col("c_custkey")).alias("c_lat"), fx.key_longitude(F.col("c_custkey")).alias("c_lon"))
    s = fx.table(spark, d, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("s_nation"),
        fx.key_latitude(F.col("s_suppkey")).alias("s_lat"), fx.key_longitude(F.col("s_suppkey")).alias("s_lon"))
    # Points first: customers (and suppliers) that share a point meet once, so the rows are one per customer.
    spots = s.groupBy("s_nation", "s_lat", "s_lon").agg(F.count(F.lit(1)).alias("_suppliers"))
    places = c.select("c_nation", "c_lat", "c_lon").distinct()
    j = joins.proximity_join(places, spots, [("c_nation", "s_nation")], ("c_lat", "c_lon"), ("s_lat", "s_lon"),
                             jobs.MATCH_DISTANCE_KM, "lambert")
    near = j.groupBy("c_nation", "c_lat", "c_lon").agg(F.sum("_suppliers").alias("n_suppliers"),
                                                       F.min("distance_km").alias("nearest_km"),
                                                       F.max("distance_km").alias("farthest_km"))
    return c.join(near, ["c_nation", "c_lat", "c_lon"]).select(
        "c_custkey", _long("c_nation").alias("nationkey"), _long("n_suppliers").alias("n_suppliers"),
        _r6("nearest_km").alias("nearest_km"), _r6("farthest_km").alias("farthest_km"))


def geo_distance_haversine(spark: SparkSession, d: str) -> DataFrame:
    """Every customer's distance to the point of its nation."""
    k = F.col("c_custkey")
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey", fx.key_latitude(k).alias("c_lat"),
                                              fx.key_longitude(k).alias("c_lon"))
    n = fx.table(spark, d, "nation").select("n_nationkey", fx.key_latitude(F.col("n_nationkey")).alias("n_lat"),
                                            fx.key_longitude(F.col("n_nationkey")).alias("n_lon"))
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    return j.select(_long("c_custkey").alias("c_custkey"), _long("n_nationkey").alias("n_nationkey"),
                    _r6(geo.haversine_km("c_lat", "c_lon", "n_lat", "n_lon")).alias("distance_km"))


def _abs_int_text(x: Column) -> Column:
    return F.abs(x).cast("string")


def hemisphere_parse(spark: SparkSession, d: str) -> DataFrame:
    n = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("n_nationkey"),
                                              (F.col("c_nationkey") % 5).alias("n_regionkey"))
    k = F.col("n_nationkey")
    lat_i = (k * 7) % 120 - 60
    lon_i = (k * 13) % 340 - 170
    lat_txt = F.concat(_abs_int_text(lat_i), F.lit(".5"), F.when(lat_i >= 0, F.lit("N")).otherwise(F.lit("S")))
    lon_core = F.concat(_abs_int_text(lon_i), F.lit(".25"))
    lon_sfx = F.when(lon_i >= 0, F.lit("E")).otherwise(F.lit("W"))
    lon_txt = (F.when(F.col("n_regionkey") == 3, F.concat(lon_core, F.lower(lon_sfx)))
                .when(F.col("n_regionkey") == 4, lon_core)
                .otherwise(F.concat(lon_core, lon_sfx)))
    t = n.select("n_nationkey", lat_txt.alias("lat_text"), lon_txt.alias("lon_text"))
    return t.select(
        _long("n_nationkey").alias("c_custkey"), "lat_text", "lon_text",
        _r6(geo.latitude_degrees("lat_text")).alias("latitude"),
        _r6(geo.longitude_degrees("lon_text")).alias("longitude"),
        _r6(geo.hemisphere_degrees_lenient(F.lower("lat_text"), "N", "S")).alias("latitude_ci"),
        _r6(geo.hemisphere_degrees_lenient("lon_text", "E", "W")).alias("longitude_ci"),
    )


def coordinate_split(spark: SparkSession, d: str) -> DataFrame:
    n = fx.table(spark, d, "customer").select(F.col("c_custkey").alias("n_nationkey"),
                                              (F.col("c_nationkey") % 5).alias("n_regionkey"))
    k = F.col("n_nationkey")
    lon_t = F.concat((F.lit(-125) + k % 59).cast("string"), F.lit(".5"))
    lat_t = F.concat((F.lit(24) + k % 26).cast("string"), F.lit(".5"))
    coords = (F.when(F.col("n_regionkey") == 3, F.lit("0, 0"))
               .when(F.col("n_regionkey") == 4, F.concat(lon_t, F.lit(" "), lat_t))
               .otherwise(F.concat(lon_t, F.lit(", "), lat_t)))
    t = n.select("n_nationkey", coords.alias("coordinates"))
    xy = geo.split_coordinates("coordinates")
    return t.select(_long("n_nationkey").alias("c_custkey"), "coordinates",
                    _r6(xy["longitude"]).alias("longitude"), _r6(xy["latitude"]).alias("latitude"))


def fill_and_replace(spark: SparkSession, d: str) -> DataFrame:
    c = fx.table(spark, d, "customer")
    zero = F.col("c_nationkey") == 0
    lon = F.when(zero, F.lit(0.0)).otherwise(fx.key_longitude(F.col("c_custkey")))
    lat = F.when(zero, F.lit(0.0)).otherwise(fx.key_latitude(F.col("c_custkey")))
    elev = F.when(F.col("c_acctbal") < 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal"))
    t = c.select("c_custkey", lon.alias("longitude"), lat.alias("latitude"), elev.alias("elevation_ft"))
    t = t.na.fill({"elevation_ft": geo.DEFAULT_ELEVATION_FT})
    return t.select("c_custkey", _r6(geo.replace_zero("longitude", geo.JFK_LONGITUDE)).alias("longitude"),
                    _r6(geo.replace_zero("latitude", geo.JFK_LATITUDE)).alias("latitude"),
                    _r6("elevation_ft").alias("elevation_ft"))


# --------------------------------------------------------- text (I1-I9, I13..)
def _city_state(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "part")
    st = F.upper(F.substring("p_type", 1, 2))
    return p.select("p_partkey", "p_name", "p_type", "p_brand", "p_size", st.alias("st"))


def city_state_split(spark: SparkSession, d: str) -> DataFrame:
    p = _city_state(spark, d)
    cs = F.concat(F.upper("p_name"), F.lit(", "), F.col("st"), F.lit("  "))
    t = p.select("p_partkey", cs.alias("city_state"))
    both = text.split_city_state("city_state")
    return t.select("p_partkey", "city_state",
                    text.all_but_last_token("city_state").alias("city"),
                    text.last_token("city_state").alias("state"),
                    both["city"].alias("city_with_space"))


def city_state_reparse(spark: SparkSession, d: str) -> DataFrame:
    p = _city_state(spark, d)
    mark = (F.when(F.col("p_type") == "PROMO", F.lit(" (BPS)"))
             .when(F.col("p_type") == "LARGE", F.lit(" #ARPT")).otherwise(F.lit("")))
    cs = F.concat(F.upper("p_name"), F.lit(", "), F.col("st"), mark)
    t = p.select("p_partkey", cs.alias("city_state"))
    return jobs.parse_city_state(t, "city_state").select("p_partkey", "city_state", "city", "state_code")


def trim_suffix(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "part")
    quoted = F.concat(F.lit("'"), F.col("p_name"), F.lit("' "))
    dashed = F.when(F.col("p_size") > 25, F.concat(F.col("p_brand"), F.lit(" - "), F.col("p_name"))).otherwise(F.col("p_name"))
    ended = F.concat(F.col("p_name"), F.when(F.col("p_size") % 2 == 0, F.lit(",")).otherwise(F.lit(" ")))
    lead = F.concat(F.lit(" "), F.col("p_name"))
    return p.select(
        "p_partkey",
        text.remove_quotes(quoted).alias("unquoted"),
        text.text_after_dash(dashed).alias("after_dash"),
        text.strip_trailing_comma(ended).alias("no_comma"),
        text.strip_trailing_comma_or_space(ended).alias("no_comma_space"),
        text.drop_first_char(lead).alias("no_lead"),
    )


def substr_codes(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    return o.select("o_orderkey",
                    text.first_char("o_orderpriority").alias("mode_code"),
                    text.inner_slice("o_orderpriority").alias("mode_name"),
                    text.right_chars("o_orderpriority", 2).alias("last_two"),
                    text.lower("o_orderstatus").alias("status"))


# ------------------------------------------------------------- dates (I15..)
def sas_date_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    days = F.datediff(F.to_date("o_orderdate"), F.lit(dates.SAS_EPOCH).cast("date")).cast("double") + 0.5
    sas = F.when(F.col("o_orderstatus") == "P", F.lit(0.0)).otherwise(days)
    t = o.select("o_orderkey", sas.alias("sas_day"))
    return t.select("o_orderkey", "sas_day", dates.sas_to_date("sas_day").alias("arrival_date"))


def compact_date_parse(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    compact = F.concat(F.date_format("o_orderdate", "yyyyMMdd"),
                       F.when(F.col("o_orderstatus") == "P", F.lit("x")).otherwise(F.lit("")))
    t = o.select("o_orderkey", compact.alias("compact"))
    parsed = dates.compact_to_date("compact")
    return t.select("o_orderkey", "compact", parsed.alias("add_to_file_date"),
                    F.date_format(parsed, "yyyy-MM-dd").alias("iso_text"))


def _stay_rows(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    return o.select("o_orderkey", "o_orderstatus",
                    fx.stay_text(F.col("o_orderstatus"), F.to_date("o_orderdate")).alias("dtaddto"))


def stay_date_normalise(spark: SparkSession, d: str) -> DataFrame:
    t = _stay_rows(spark, d)
    return t.select("o_orderkey", "dtaddto", dates.stay_date("dtaddto").alias("allow_to_stay"),
                    dates.stay_pattern_ok("dtaddto").alias("pattern_ok"))


def regex_filter(spark: SparkSession, d: str) -> DataFrame:
    t = _stay_rows(spark, d)
    ok = dates.stay_pattern_ok("dtaddto")
    loose = dates.stay_pattern_ok("dtaddto", dates.STAY_PATTERN_LOOSE)
    return t.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(ok).cast("long").alias("n_kept"),
        F.count_if(~ok).cast("long").alias("n_rejected"), F.count_if(loose).cast("long").alias("n_kept_loose"))


def month_token(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    od = F.to_date("o_orderdate")
    return o.groupBy(dates.month_token(od).alias("month_token"), dates.year_month(od).alias("year_month")).agg(
        F.count(F.lit(1)).alias("count"))


# -------------------------------------------------------------- shape (B*)
BULK_RENAMES = {
    "l_orderkey": "Order Key", "l_partkey": "Part-Key", "l_suppkey": "Supp-Key",
    "l_linenumber": "Line Number", "l_quantity": "Quantity", "l_extendedprice": "Extended Price",
    "l_discount": "Discount", "l_tax": "tax2", "l_returnflag": "Return-Flag",
    "l_linestatus": "Line Status", "l_shipdate": "Ship Date",
}


def bulk_cast(spark: SparkSession, d: str) -> DataFrame:
    li = fx.table(spark, d, "lineitem").withColumnsRenamed(BULK_RENAMES)
    li = shape.strip_trailing_2(shape.clean_names(li))
    li = shape.cast_columns(li, ["quantity", "line_number"], "bigint")
    return shape.cast_columns(li, ["ship_date"], "date")


# ------------------------------------------------------------ filters (C*)
def prefix_exclude(spark: SparkSession, d: str) -> DataFrame:
    c = fx.table(spark, d, "customer")
    cs = (F.when(F.col("c_mktsegment") == "HOUSEHOLD",
                 F.concat(F.lit("No PORT Code ("), F.col("c_custkey").cast("string"), F.lit(")")))
           .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("Collapsed ("), F.col("c_name"), F.lit(")")))
           .otherwise(F.concat(F.col("c_name"), F.lit(", "),
                               F.when(F.col("c_nationkey") == 0, F.lit("MX")).otherwise(F.lit("US")))))
    t = c.select("c_custkey", cs.alias("city_state"))
    t = filters.exclude_prefixes(t, "city_state", jobs.JUNK_PORT_PREFIXES)
    return t.where(~text.right_chars("city_state", 2).isin(jobs.EXCLUDED_STATE_CODES))


CONTAINS_WORDS = ["ring", "bolt"]


def contains_any_exclude(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "part").select("p_partkey", "p_name")
    p = filters.exclude_containing(p, "p_name", CONTAINS_WORDS)
    return p.withColumn("has_gear", F.col("p_name").contains("gear"))


ALLOW_BRANDS = ["Brand#1", "Brand#2"]
DENY_TYPES = ["PROMO"]


def allow_deny_list(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "part").select("p_brand", "p_type", "p_partkey", "p_name")
    kept = filters.allow_deny(p, F.col("p_name").contains("gear"), allow=F.col("p_brand").isin(ALLOW_BRANDS),
                              deny=F.col("p_type").isin(DENY_TYPES))
    return first_per_key(kept, ["p_brand", "p_type"], order=["p_partkey"])


def length_branches(spark: SparkSession, d: str) -> DataFrame:
    p = fx.table(spark, d, "part")
    tok = text.last_token("p_name")
    four = F.length(tok) == 4
    return p.select("p_partkey", F.when(four, tok).otherwise(F.upper(tok)).alias("token"),
                    F.when(four, F.lit("a")).otherwise(F.lit("b")).alias("branch"))


def drop_null_rows(spark: SparkSession, d: str) -> DataFrame:
    li = fx.table(spark, d, "lineitem").select(
        F.year("l_shipdate").alias("ship_year"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc"),
        F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(F.col("l_linestatus")).alias("status"))
    # The kept rows and the dropped ones are counted by one aggregate over one read.
    kept = filters.any_null(["flag", "disc"]) | filters.is_empty("status")
    return li.groupBy(_long("ship_year").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("flag").isNull()).cast("long").alias("n_null_flag"),
        F.count_if(~kept).cast("long").alias("n_kept"))


def dropped_rows(spark: SparkSession, d: str) -> DataFrame:
    """Line items that survive ``drop_null_rows`` and ``non_empty``, whole rows."""
    li = fx.table(spark, d, "lineitem").select(
        "l_orderkey", _long("l_linenumber").alias("l_linenumber"),
        F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("disc"),
        F.when(F.col("l_linestatus") == "O", F.lit("")).otherwise(F.col("l_linestatus")).alias("status"))
    return filters.non_empty(filters.drop_null_rows(li, ["flag", "disc"]), "status")


# ---------------------------------------------------------------- joins (D*)
def _name_number(c: str) -> Column:
    return F.lower(F.regexp_extract(F.col(c), r"#(\d+)$", 1))


def two_key_join(spark: SparkSession, d: str) -> DataFrame:
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey", _name_number("c_name").alias("c_num"))
    s = fx.table(spark, d, "supplier").select("s_suppkey", "s_nationkey", _name_number("s_name").alias("s_num"))
    j = c.join(s, (c["c_num"] == s["s_num"]) & (c["c_nationkey"] == s["s_nationkey"]), "inner").drop("s_nationkey", "s_num")
    return j.select("c_custkey", "s_suppkey", _long("c_nationkey").alias("nationkey"), F.col("c_num").alias("name_number"))


def role_lookup(spark: SparkSession, d: str) -> DataFrame:
    li = fx.table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    s = fx.table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = fx.table(spark, d, "nation").select("n_nationkey", "n_name")
    ls = li.join(s, li["l_suppkey"] == s["s_suppkey"])
    # fold lines per (order, supplier nation) before meeting orders and customers
    per_order = ls.groupBy("l_orderkey", "s_nationkey").agg(F.count(F.lit(1)).alias("_n"))
    oc = o.join(c, o["o_custkey"] == c["c_custkey"]).select("o_orderkey", "c_nationkey")
    j = per_order.join(oc, per_order["l_orderkey"] == oc["o_orderkey"])
    g = j.groupBy("c_nationkey", "s_nationkey").agg(F.sum("_n").alias("n_lines"))
    g = joins.role_lookup(g, n, "n_nationkey", "c_nationkey", "cust_", "inner")
    g = joins.role_lookup(g, n, "n_nationkey", "s_nationkey", "supp_", "inner")
    return g.select(F.col("cust_n_name").alias("cust_nation"), F.col("supp_n_name").alias("supp_nation"),
                    _long("n_lines").alias("n_lines"))


def code_lookup(spark: SparkSession, d: str) -> DataFrame:
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = fx.table(spark, d, "nation")
    r = fx.table(spark, d, "region")
    j = joins.lookup(c, n, "c_nationkey", "n_nationkey", "inner")
    j = joins.lookup(j, r, "n_regionkey", "r_regionkey", "left")
    return j.select("c_custkey", "n_name", "r_name")


def unmatched_codes(spark: SparkSession, d: str) -> DataFrame:
    """Orders without a line item."""
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = fx.table(spark, d, "lineitem").select("l_orderkey")
    return joins.unmatched(o, li, "o_orderkey", "l_orderkey")


def unmatched_states(spark: SparkSession, d: str) -> DataFrame:
    """State codes of the parts' city text that the state list (regions) lacks."""
    p = _city_state(spark, d)
    ports = p.select(F.when(F.col("p_size") > 25, F.col("st")).otherwise(
        fx.state_code(F.element_at(F.array(*[F.lit(n) for n in STATE_SOURCES]), F.col("p_size") % 5 + 1)))
        .alias("state_code"))
    states = fx.table(spark, d, "region").select(fx.state_code(F.col("r_name")).alias("state_code"))
    return jobs.unmatched_state_codes(ports, states)


#: Fixed names whose first two letters are the states of the parts with small sizes; two are no regions.
STATE_SOURCES = ["AFRICA", "AMERICA", "ASIA", "NOWHERE", "ZZ"]


def join_recovery(spark: SparkSession, d: str) -> DataFrame:
    fact = fx.entry_rows(spark, d)
    temp = fx.known_temperatures(fx.temperature_dim(spark, d))
    r = jobs.join_recovery(fact, fx.port_rows(spark, d), temp)
    return r.select("n_rows", "n_recovered", _r6("recovery").alias("recovery"))


# ------------------------------------------------------------- profiles (E*)
NULLABLE_LINEITEM = {"l_returnflag": "R", "l_discount": 0.0, "l_tax": 0.0, "l_linestatus": "O"}


def null_audit(spark: SparkSession, d: str) -> DataFrame:
    li = fx.table(spark, d, "lineitem")
    li = li.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in NULLABLE_LINEITEM.items()})
    return agg.null_counts(li)


def distinct_rows_q(spark: SparkSession, d: str) -> DataFrame:
    c = fx.table(spark, d, "customer")
    return distinct_rows(c, ["c_nationkey", "c_mktsegment"]).select(
        _long("c_nationkey").alias("c_nationkey"), "c_mktsegment")


def dedup_by_key(spark: SparkSession, d: str) -> DataFrame:
    li = fx.table(spark, d, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    out = first_per_key(li, ["l_orderkey", "l_linenumber"])
    return out.withColumn("l_linenumber", _long("l_linenumber"))


def value_profile(spark: SparkSession, d: str) -> DataFrame:
    e = fx.table(spark, d, "events")
    g = e.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count_distinct("user_id").alias("n_users"),
                                    F.count_if(F.col("value") > 10).cast("long").alias("n_high"))
    total = F.sum("n_rows").over(Window.partitionBy())  # over one row per event type
    return g.select("event_type", "n_rows", "n_users", _r6(F.col("n_rows") / total).alias("share"), "n_high")


def top_n(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    counts = o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"))
    top = agg.top_n(counts, 25, [F.desc("n_orders"), F.asc("o_custkey")])
    c = fx.table(spark, d, "customer").select("c_custkey", "c_name")
    return top.join(c, top["o_custkey"] == c["c_custkey"]).select("c_custkey", "c_name", "n_orders", "rank")


def _fact_with_nation(spark: SparkSession, d: str) -> DataFrame:
    f = fx.entry_rows(spark, d)
    n = fx.table(spark, d, "nation").select("n_nationkey", "n_name")
    return f.join(n, f["i94port_city_code"] == n["n_nationkey"])


def top_n_share(spark: SparkSession, d: str) -> DataFrame:
    c = jobs.concentration(fx.entry_rows(spark, d), "i94port_city_code", 10)
    n = fx.table(spark, d, "nation").select("n_nationkey", "n_name")
    return c.join(n, c["i94port_city_code"] == n["n_nationkey"]).select(
        "n_name", "count", "rank", _r6("top_share").alias("top_share"))


def category_share(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    p = jobs.visa_stay_profile(o, visa_col="o_orderstatus", stay_col="o_orderpriority", token="1-URGENT")
    return p.select("o_orderstatus", "n_rows", "n_token", _r6("token_share").alias("token_share"))


def demographics_mean(spark: SparkSession, d: str) -> DataFrame:
    c = fx.table(spark, d, "customer")
    n = fx.table(spark, d, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"])
    g = agg.numeric_means(j.select("n_name", "c_mktsegment", "c_custkey", "c_acctbal"), ["n_name", "c_mktsegment"],
                          "n_customers")
    return g.select("n_name", "c_mktsegment", *[_r6(c).alias(c) for c in ("avg_c_custkey", "avg_c_acctbal")],
                    "n_customers")


def missing_departure_profile(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    dep = F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("date")).otherwise(F.date_add(F.to_date("o_orderdate"), 30))
    t = o.select("o_custkey", dep.alias("departure_date")).where(F.col("departure_date").isNull())
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    j = t.join(c, t["o_custkey"] == c["c_custkey"])
    g = jobs.counts_by(j, "c_nationkey")
    return g.select(_long("c_nationkey").alias("c_nationkey"), F.col("count").alias("n_no_departure"))


def keyed_override(spark: SparkSession, d: str) -> DataFrame:
    """Customers, with the name of the supplier of the same key where there is one."""
    c = fx.table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    overrides = fx.table(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_name").alias("c_name"))
    o = apply_overrides(c, overrides, "c_custkey", ["c_name"])
    return o.select(_long("c_custkey").alias("c_custkey"), "c_name", _long("c_nationkey").alias("c_nationkey"))


def entity_profiles(spark: SparkSession, d: str) -> DataFrame:
    keys = ["n_name", "c_mktsegment", "o_orderstatus", "o_orderpriority"]
    return jobs.top_profiles(_fact_with_nation(spark, d), keys, 20)


def quality_counts(spark: SparkSession, d: str) -> DataFrame:
    checks = quality.row_counts({t: fx.table(spark, d, t) for t in ALL_TABLES})
    return quality.assert_quality(checks)


# ---------------------------------------------------------- pipelines (M*)
def port_dimension(spark: SparkSession, d: str) -> DataFrame:
    book, states = fx.port_code_book(spark, d)
    return jobs.port_dimension(book, states)


def fact_raw(spark: SparkSession, d: str) -> DataFrame:
    """Raw monthly-record shaped rows built from orders x customer (doubles, codes, texts)."""
    o = fx.table(spark, d, "orders")
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o["o_custkey"] == c["c_custkey"])
    od = F.to_date("o_orderdate")
    arr = F.datediff(od, F.lit(dates.SAS_EPOCH).cast("date")).cast("double")
    return j.select(
        F.col("o_orderkey").cast("double").alias("cicid"),
        F.year(od).cast("double").alias("i94yr"), F.month(od).cast("double").alias("i94mon"),
        F.col("c_nationkey").cast("double").alias("i94cit"),
        (F.col("c_nationkey") + 100).cast("double").alias("i94res"),
        fx.port_code(F.col("c_nationkey")).alias("i94port"),
        arr.alias("arrdate"), F.lit(1.0).alias("i94mode"), F.col("c_mktsegment").alias("i94addr"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("double")).otherwise(arr + 10).alias("depdate"),
        ((F.col("o_custkey") % 80) + 18).cast("double").alias("i94bir"),
        F.lit(2.0).alias("i94visa"), F.lit(1.0).alias("count"),
        F.date_format(od, "yyyyMMdd").alias("dtadfile"),
        fx.stay_text(F.col("o_orderstatus"), od).alias("dtaddto"),
        F.concat(F.lit("AL"), F.substring("o_orderpriority", 1, 1)).alias("airline"),
        (F.col("o_orderkey") * 100000 + F.col("o_custkey")).cast("double").alias("admnum"),
        F.col("o_custkey").cast("string").alias("fltno"),
        F.when(F.col("o_orderstatus") == "F", F.lit("F1")).otherwise(F.lit("B2")).alias("visatype"),
    )


def retention_audit(spark: SparkSession, d: str) -> DataFrame:
    """Rows into and out of the fact cleaning job and the share kept (one read of the raw rows)."""
    r = jobs.entry_retention(fact_raw(spark, d))
    return r.select("n_in", "n_out", _r6("retention").alias("retention"))


def missing_histogram(spark: SparkSession, d: str) -> DataFrame:
    """Rows per ``departure IS NULL`` and distinct departure days per group, null counted as a value."""
    return agg.null_histogram(fact_raw(spark, d), "depdate")


def fact_clean(spark: SparkSession, d: str) -> DataFrame:
    f = jobs.entry_fact_narrow(write_stage(fact_raw(spark, d), "raw_entries"))
    return f.select(*[_long(c).alias(c) if c in jobs.FACT_INT_COLUMNS else F.col(c) for c in jobs.FACT_COLUMNS])


AIRPORT_ALLOW = ["Supplier#000000001", "Supplier#000000002"]
AIRPORT_DENY = ["Supplier#000000003"]


def airport_rows(spark: SparkSession, d: str) -> DataFrame:
    """Supplier rows shaped like the airport code list."""
    s = fx.table(spark, d, "supplier")
    nr = fx.nation_dim(spark, d)
    j = s.join(nr, s["s_nationkey"] == nr["n_nationkey"])
    k = F.col("s_suppkey")
    coords = F.when(F.col("s_nationkey") == 0, F.lit("0, 0")).otherwise(
        F.concat((F.lit(-125) + k % 59).cast("string"), F.lit(", "), (F.lit(24) + k % 26).cast("string")))
    return j.select(
        F.col("s_name").alias("ident"),
        F.when(F.col("s_acctbal") > 0, F.lit("large_airport")).otherwise(F.lit("small_airport")).alias("type"),
        F.when(k % 3 == 0, F.concat(F.lit("International "), F.col("s_name")))
         .otherwise(F.concat(F.lit("Field "), F.col("s_name"))).alias("name"),
        F.when(F.col("s_acctbal") > 5000, F.lit(None).cast("string"))
         .otherwise(F.floor("s_acctbal").cast("string")).alias("elevation_ft"),
        F.lit("NA").alias("continent"), F.lit("US").alias("iso_country"),
        F.concat(F.lit("US-"), fx.state_code(F.col("r_name"))).alias("iso_region"),
        F.col("n_name").alias("municipality"), F.lit(None).cast("string").alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"), F.lit(None).cast("string").alias("local_code"),
        coords.alias("coordinates"),
    )


def _airport_port(spark: SparkSession, d: str) -> DataFrame:
    return jobs.airport_port_join(airport_rows(spark, d), port_dimension(spark, d),
                                  allow=AIRPORT_ALLOW, deny=AIRPORT_DENY)


def airport_port_join(spark: SparkSession, d: str) -> DataFrame:
    a = jobs.airport_dimension(_airport_port(spark, d))
    return a.select(*[_r6(c).alias(c) if c in ("elevation_ft", "airport_longitude", "airport_latitude") else F.col(c)
                      for c in a.columns])


def temperature_rows(spark: SparkSession, d: str, window: tuple[str, str]) -> DataFrame:
    """lineitem x supplier x nation of a date window, shaped like the global city temperature file."""
    li = fx.table(spark, d, "lineitem").where(fx.ship_filter(*window)).select("l_suppkey", "l_quantity", "l_shipdate")
    s = fx.table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    nr = fx.nation_dim(spark, d)
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(nr, F.col("s_nationkey") == nr["n_nationkey"])
    k = F.col("n_nationkey")
    return j.select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("dt"),
        F.col("l_quantity").cast("string").alias("AverageTemperature"),
        F.lit("0.5").alias("AverageTemperatureUncertainty"),
        F.col("n_name").alias("City"),
        F.when(F.col("n_regionkey") == 4, F.lit("Canada")).otherwise(F.lit(jobs.CLIMATE_COUNTRY)).alias("Country"),
        F.concat((F.lit(24) + k % 26).cast("string"), F.lit(".5N")).alias("Latitude"),
        F.concat((F.lit(125) - k % 59).cast("string"), F.lit(".5W")).alias("Longitude"),
    )


def gazetteer_rows(spark: SparkSession, d: str) -> DataFrame:
    """Distinct city points derived from customers (nation name, region state, offset latitude)."""
    c = fx.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    nr = fx.nation_dim(spark, d)
    j = c.join(nr, c["c_nationkey"] == nr["n_nationkey"])
    k = F.col("n_nationkey")
    lat = fx.key_latitude(k) + (F.col("c_custkey") % 5).cast("double") * 0.5
    g = j.select(F.col("n_name").alias("city"), fx.state_code(F.col("r_name")).alias("state_id"),
                 F.col("r_name").alias("state_name"), lat.cast("string").alias("lat"),
                 fx.key_longitude(k).cast("string").alias("lng"))
    return g.distinct()


def city_temperature_dim(spark: SparkSession, d: str) -> DataFrame:
    clim = jobs.city_climatology(temperature_rows(spark, d, fx.CLIMATE_WINDOW), window=fx.CLIMATE_WINDOW)
    ct = jobs.city_temperature(clim, gazetteer_rows(spark, d))
    return ct.select("city", _long("month").alias("month"), _r6("average_temperature").alias("average_temperature"),
                     "state_id", "state_name", _r6("lat").alias("lat"), _r6("lng").alias("lng"))


def us_cities(spark: SparkSession, d: str) -> DataFrame:
    clim = jobs.city_climatology(temperature_rows(spark, d, fx.CLIMATE_WINDOW), window=fx.CLIMATE_WINDOW)
    cities = jobs.us_cities(jobs.city_temperature(clim, gazetteer_rows(spark, d)))
    return cities.select("city", "state_id", "state_name", _r6("latitude").alias("latitude"),
                         _r6("longitude").alias("longitude"))


def airport_concentration(spark: SparkSession, d: str) -> DataFrame:
    """Top 25 ports and states of the fact joined to the airports (suppliers: several to a port)."""
    fact = fx.entry_rows(spark, d).withColumnRenamed("c_mktsegment", "destination_state_code")
    airports = fx.table(spark, d, "supplier").select(_long("s_nationkey").alias("i94port_code"))
    c = jobs.airport_concentration(fact, airports)
    return c.select("dimension", "value", _long("count").alias("count"), "rank", _r6("top_share").alias("top_share"))


# ------------------------------------------------------------- I/O (A*)
ORDER_CSV_SCHEMA = StructType([StructField("index", LongType()), StructField("o_orderkey", LongType()),
                               StructField("o_custkey", LongType()), StructField("o_orderpriority", StringType())])


def csv_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Orders through a CSV with an index column, which the reader drops."""
    o = fx.table(spark, d, "orders").select(F.monotonically_increasing_id().alias("index"), "o_orderkey", "o_custkey",
                                            "o_orderpriority")
    path = writers.write_csv(o, scratch_path(spark, "csv_roundtrip"))
    return readers.read_csv(spark, path, ORDER_CSV_SCHEMA, header=True, drop=["index"])


def sorted_head(spark: SparkSession, d: str) -> DataFrame:
    """The 50 dearest orders, a total order and its position."""
    o = fx.table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return agg.top_n(o, 50, [F.desc("o_totalprice"), F.asc("o_orderkey")], "position")


DRIFT_COLUMNS = ["validres", "delete_days", "delete_visa"]
MONTH_TEMPLATE = "token={token}"
MONTH_RANGE = ("1995-01-01", "2001-12-31")


def drifting_month_scan(spark: SparkSession, d: str) -> DataFrame:
    """Raw monthly files, even years with extra columns, read by month range in one scan; the month from the path."""
    raw = fact_raw(spark, d).withColumn("token", dates.month_token(F.make_date(
        F.col("i94yr").cast("int"), F.col("i94mon").cast("int"), F.lit(1))))
    root = scratch_path(spark, "raw_months")
    even = F.col("i94yr") % 2 == 0
    drifted = raw.where(even).withColumns({c: F.lit(1.0) for c in DRIFT_COLUMNS})
    writers.write_parquet(drifted, root, ["token"])
    writers.write_parquet(raw.where(~even), root, ["token"], mode="append")
    schema = StructType([f for f in raw.schema.fields if f.name != "token"])
    back = readers.read_months(spark, root, *MONTH_RANGE, schema, MONTH_TEMPLATE, skip_missing=True)
    back = readers.with_file_token(back, r"token=([a-z]{3}\d{2})", "month_token")
    return back.groupBy("month_token", _long("i94yr").alias("i94yr"), _long("i94mon").alias("i94mon")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("cicid").cast("long").alias("sum_cicid"))


def delimited_scan(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers through a quoted code book, ``=`` lines and a semicolon CSV."""
    r = fx.table(spark, d, "supplier").select("s_suppkey", "s_name")
    key = F.col("s_suppkey").cast("string")
    book = writers.write_text(r.select(F.concat(F.lit("'"), key, F.lit("'\t=\t'"), F.col("s_name"), F.lit("'"))),
                              scratch_path(spark, "codebook"))
    eq = writers.write_text(r.select(F.concat(key, F.lit("="), F.col("s_name"))), scratch_path(spark, "eq"))
    semi = writers.write_csv(r, scratch_path(spark, "semi"), sep=";")
    a = readers.read_code_book(spark, book, sep="\t=\t", key="k", value="v").withColumn("fmt", F.lit("tab_eq_tab"))
    schema2 = StructType([StructField("k", StringType()), StructField("v", StringType())])
    b = readers.read_csv(spark, eq, schema2, header=False, sep="=").withColumn("fmt", F.lit("eq"))
    c = readers.read_csv(spark, semi, schema2, header=True, sep=";").withColumn("fmt", F.lit("semicolon"))
    u = reduce(DataFrame.unionByName, [a, b, c])
    return u.select("fmt", F.col("k").cast("long").alias("s_suppkey"), F.col("v").alias("s_name"))


ORDERS_PART_SCHEMA = StructType([
    StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
    StructField("o_orderstatus", StringType()), StructField("o_totalprice", DoubleType()),
    StructField("order_date", StringType()), StructField("o_orderpriority", StringType()),
    StructField("entry_year", LongType()), StructField("entry_month", LongType()),
])


def _orders_by_month(spark: SparkSession, d: str) -> DataFrame:
    o = fx.table(spark, d, "orders")
    od = F.to_date("o_orderdate")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", od.alias("order_date"),
                    "o_orderpriority", F.year(od).cast("long").alias("entry_year"),
                    F.month(od).cast("long").alias("entry_month"))


def partitioned_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    path = writers.write_parquet(_orders_by_month(spark, d), scratch_path(spark, "orders_by_month"),
                                 ["entry_year", "entry_month"])
    schema = StructType([f if f.name != "order_date" else StructField("order_date", dates_type())
                         for f in ORDERS_PART_SCHEMA.fields])
    return readers.read_parquet(spark, path, schema)


def dates_type():
    from pyspark.sql.types import DateType

    return DateType()


def multi_file_month_scan(spark: SparkSession, d: str) -> DataFrame:
    a = analytical_rows(spark, d).select(
        dates.year_month(F.make_date("entry_year", "entry_month", F.lit(1))).alias("year_month"),
        _long("i94port_city_code").alias("i94port_city_code"), _long("entry_month").alias("entry_month"),
        _long("count").alias("count"), _long("rank").alias("rank"))
    # One file a month, named after it, rows by descending count with their position; the month is read off the name.
    path = writers.write_monthly_csv(a, scratch_path(spark, "monthly_export"), "year_month",
                                     [F.desc("count"), F.asc("i94port_city_code")], "port_entry_{month}.csv")
    schema = StructType([StructField(n, LongType()) for n in ("index", "i94port_city_code", "entry_month", "count", "rank")])
    back = readers.read_csv(spark, f"{path}/port_entry_*.csv", schema, header=True)
    back = readers.with_file_token(back, r"port_entry_(\d{4}-\d{2})\.csv", "year_month")
    return back.select("year_month", "index", "i94port_city_code", "entry_month", "count", "rank")


def incremental_month_load(spark: SparkSession, d: str) -> DataFrame:
    rows = _orders_by_month(spark, d)
    path = scratch_path(spark, "incremental")
    writers.write_parquet(rows, path, ["entry_year", "entry_month"])
    # a re-run of one year's months replaces just those partitions
    writers.write_parquet(rows.where(F.col("entry_year") == 1998), path, ["entry_year", "entry_month"], dynamic=True)
    back = readers.read_parquet(spark, path, StructType([f for f in ORDERS_PART_SCHEMA.fields if f.name != "order_date"]))
    return back.groupBy("entry_year", "entry_month").agg(F.count(F.lit(1)).alias("n_rows"))


EVENTS_SCHEMA = StructType([
    StructField("event_id", LongType()), StructField("ts", TimestampNTZType()), StructField("user_id", LongType()),
    StructField("event_type", StringType()), StructField("value", DoubleType()),
    StructField("props", StringType()),
])
EVENTS_KEY = "events/{year}/{month:02d}"


def json_stage_load(spark: SparkSession, d: str) -> DataFrame:
    """Events staged as JSON under a date-templated key, then appended to a table with all their columns."""
    e = fx.table(spark, d, "events").select([f.name for f in EVENTS_SCHEMA.fields])
    root = scratch_path(spark, "stage")
    staged = writers.write_json(e, readers.staged_path(root, EVENTS_KEY, _dt.date(2024, 1, 1)))
    with writers.temporary_table(spark, "events", ", ".join(f"{f.name} {f.dataType.simpleString()}"
                                                            for f in EVENTS_SCHEMA.fields)) as name:
        writers.insert(readers.read_json_staged(spark, staged, EVENTS_SCHEMA), name)
        t = writers.read_back(spark, name)
    return t.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"),
                                       _r6(F.sum("value")).alias("total_value"),
                                       F.count_distinct("user_id").alias("n_users"),
                                       F.date_format(F.min("ts"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"),
                                       F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


def insert_fact(spark: SparkSession, d: str) -> DataFrame:
    rows = fx.entry_rows(spark, d).select("o_orderkey", F.col("i94port_city_code").alias("port"), "entry_year",
                                          "entry_month")
    with writers.temporary_table(spark, "entry_fact", "o_orderkey BIGINT, port BIGINT, entry_year INT, entry_month INT",
                                 ["entry_year", "entry_month"]) as name:
        writers.insert(rows, name, ["entry_year", "entry_month"])
        t = writers.read_back(spark, name)
    return t.groupBy(F.col("port").alias("port"), _long("entry_year").alias("entry_year"),
                     _long("entry_month").alias("entry_month")).agg(F.count(F.lit(1)).alias("n_orders"))


def insert_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers with their nation, inserted, and replaced by a second run."""
    supplier, nation = fx.table(spark, d, "supplier"), fx.table(spark, d, "nation")
    j = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
    rows = j.select(_long("s_suppkey").alias("s_suppkey"), "s_name", "n_name")
    with writers.temporary_table(spark, "supplier_dim", "s_suppkey BIGINT, s_name STRING, n_name STRING") as name:
        writers.insert(rows, name)
        writers.insert(rows, name, overwrite=True)  # re-run does not duplicate rows
        return writers.read_back(spark, name)


def ordered_month_export(spark: SparkSession, d: str) -> DataFrame:
    """Orders of each month by price, numbered over many tasks, through a CSV of several ordered parts a month."""
    o = fx.table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("year_month"), "o_orderkey",
                                            "o_totalprice")
    path = writers.write_ordered_csv(o, scratch_path(spark, "ordered_months"), "year_month",
                                     [F.desc("o_totalprice"), F.asc("o_orderkey")])
    schema = "index long, o_orderkey long, o_totalprice double, year_month string, part string"
    return spark.read.schema(schema).option("header", True).csv(path).select("year_month", "index", "o_orderkey")


def quarantined_scan(spark: SparkSession, d: str) -> DataFrame:
    """Orders as CSV lines, some with a text for the price or a field missing, read as good rows and a quarantine table."""
    o = fx.table(spark, d, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice").cast("string")
    line = (F.when(key % 10 == 0, F.concat_ws(",", key, F.lit("n/a"), "o_orderstatus"))
            .when(key % 10 == 1, F.concat_ws(",", key, price)).otherwise(F.concat_ws(",", key, price, "o_orderstatus")))
    path = writers.write_text(o.select(line), scratch_path(spark, "dirty"))
    schema = StructType([StructField("o_orderkey", LongType()), StructField("o_totalprice", DoubleType()),
                         StructField("o_orderstatus", StringType())])
    good, bad = readers.read_csv_checked(spark, path, schema, header=False)
    rows = good.select(F.lit("good").alias("kind"), "o_orderkey").unionByName(
        bad.select(F.col("reason").alias("kind"), F.split("record", ",")[0].cast("long").alias("o_orderkey")))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_orderkey"))


def distinct_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Distinct customers per year from sketches kept per month, against the exact count."""
    o = fx.table(spark, d, "orders").select("o_custkey", F.year("o_orderdate").cast("long").alias("entry_year"),
                                            F.month("o_orderdate").alias("entry_month"))
    monthly = write_stage(agg.distinct_sketches(o, ["entry_year", "entry_month"], "o_custkey"), "distinct_sketches")
    estimated = agg.merged_distinct(monthly, ["entry_year"], "_estimate")
    exact = o.groupBy(F.col("entry_year").alias("_year")).agg(F.count_distinct("o_custkey").alias("n_customers"))
    both = exact.join(estimated, F.col("entry_year") == F.col("_year"))
    return both.select("entry_year", "n_customers",
                       (F.abs(F.col("_estimate") - F.col("n_customers")) <= 0.05 * F.col("n_customers")).alias("within"))


def sliced_load(spark: SparkSession, d: str) -> DataFrame:
    """Events loaded by day: first without every seventh event, then whole (late rows), then again; and by month."""
    e = fx.table(spark, d, "events").select("event_id", "ts", "user_id", "value")
    schema = "event_id long, ts timestamp_ntz, user_id long, value double"
    found = []
    for grain in ("month", "day"):
        root = scratch_path(spark, f"events_by_{grain}")
        slices.load(e.where(F.col("event_id") % 7 != 0), root, "ts", grain)
        late = slices.load(e, root, "ts", grain)
        again = slices.load(e, root, "ts", grain)
        if not again.isEmpty():
            raise AssertionError("a load of the same rows must change nothing")
        replaced = late.select(F.col("slice").alias("_slice"), F.lit(1).alias("_late"))
        rows = slices.read(spark, root, schema)
        found.append(rows.join(replaced, F.col("slice") == F.col("_slice"), "left")
                     .groupBy(F.lit(grain).alias("grain"), "slice").agg(
                         F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("sum_event_id"),
                         (F.max("_late") == 1).alias("replaced")))
    return reduce(DataFrame.unionByName, found).withColumn("replaced", F.coalesce("replaced", F.lit(False)))


def observed_fact_load(spark: SparkSession, d: str) -> DataFrame:
    """Rows read and kept, and rows by visa type, counted while the fact is written: one read of the raw rows."""
    read = Observation()
    raw = fact_raw(spark, d).observe(read, F.count(F.lit(1)).alias("n_in"))
    kept = writers.write_observed(jobs.entry_fact(raw), scratch_path(spark, "observed_fact"),
                                  {"n_out": F.count(F.lit(1)), "n_f1": F.count_if(F.col("visa_type") == "F1"),
                                   "n_ports": F.approx_count_distinct("i94port_city_code")})
    n_in, n_out = read.get["n_in"], kept["n_out"]
    one = spark.createDataFrame([(n_in, n_out, kept["n_f1"])], "n_in long, n_out long, n_f1 long")
    return one.withColumn("retention", _r6(F.try_divide("n_out", "n_in")))


def file_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of every table from the footers of its files."""
    counts = quality.file_row_counts(spark, {t: f"{d.rstrip('/')}/{t}.parquet" for t in ALL_TABLES})
    return spark.createDataFrame(sorted(counts.items()), "table_name string, n_rows long")


def _no_repeats_or_gaps(tables: dict[str, DataFrame]) -> DataFrame:
    fact = tables["entry_fact"]
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in jobs.FACT_COLUMNS])
    return quality.unique_key(fact, "fact: cicid twice", ["cicid"]).unionByName(
        quality.violations(fact, "fact: a column missing", missing))


def published_release(spark: SparkSession, d: str) -> DataFrame:
    """The fact of all years is published; a run that lost most rows and one with repeated rows fail their audits.

    Read through the release log afterwards: the rows of the published fact per port and year, and the release's number.
    """
    root = scratch_path(spark, "releases")
    fact = jobs.entry_fact_narrow(write_stage(fact_raw(spark, d), "raw_entries"))
    first = releases.Staging(spark, root)
    whole = first.write("entry_fact", fact, ["entry_year", "entry_month"])
    first.write("ports", port_dimension(spark, d))
    first.publish(_no_repeats_or_gaps)
    for bad in (whole.where("entry_year = 1995"), whole.unionByName(whole.where("entry_month = 1"))):
        failing = releases.Staging(spark, root)
        failing.write("entry_fact", bad, ["entry_year", "entry_month"])
        failing.carry("ports")
        try:
            failing.publish(_no_repeats_or_gaps, least_share=0.9)
        except quality.QualityCheckError:
            continue
        raise AssertionError("an audit that must fail has passed")
    release = releases.current(spark, root)
    return release.read(spark, "entry_fact").groupBy("i94port_city_code", _long("entry_year").alias("entry_year")).agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("release", F.lit(release.number).cast("long"))


def gate_counts(spark: SparkSession, d: str) -> DataFrame:
    """The three kinds of row-count gate: CSV files, parquet folders and catalog tables."""
    root = scratch_path(spark, "gates")
    writers.write_csv(fx.table(spark, d, "customer"), f"{root}/customer.csv")
    writers.write_parquet(fx.table(spark, d, "orders"), f"{root}/orders")
    checks = quality.row_counts({**quality.csv_tables(spark, root, ["customer.csv", "readme.txt"]),
                                 **quality.parquet_tables(spark, root, ["orders"])})
    with writers.temporary_table(spark, "supplier_gate", "s_suppkey BIGINT, s_name STRING") as name:
        writers.insert(fx.table(spark, d, "supplier").select("s_suppkey", "s_name"), name)
        counted = quality.row_counts({"supplier": quality.sql_tables(spark, [name])[name]})
        return quality.assert_quality(checks.unionByName(counted))


# -------------------------------------------------------------- full run (M16)
PORTS_SCHEMA = StructType([StructField(n, StringType()) for n in ("i94port_code", "city", "state_code", "state_name")])


def full_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Ports -> airports -> ports v2; climatology -> city temperature; fact; analytical; audit; publish.

    Every step hands its table to the next through the release's folder (as the scheduled jobs do). The port table is a
    CSV with a gate of its own. All other tables are staged, and become readable together once their audit has passed.
    """
    root = scratch_path(spark, "gated")
    writers.write_csv(port_dimension(spark, d), f"{root}/ports.csv")
    quality.assert_quality(quality.row_counts(quality.csv_tables(spark, root, ["ports.csv"])))
    ports = readers.read_csv(spark, f"{root}/ports.csv", PORTS_SCHEMA)
    run = releases.Staging(spark, f"{root}/warehouse")
    airport_port = write_stage(jobs.airport_port_join(airport_rows(spark, d), ports, allow=AIRPORT_ALLOW,
                                                      deny=AIRPORT_DENY), "airport_port")
    run.write("airports", jobs.airport_dimension(airport_port))
    ports2 = run.write("ports", jobs.port_dimension_v2(airport_port))
    clim = jobs.city_climatology(temperature_rows(spark, d, fx.CLIMATE_WINDOW), window=fx.CLIMATE_WINDOW)
    city_temp = run.write("city_temperature", jobs.city_temperature(clim, gazetteer_rows(spark, d)))
    run.write("us_cities", jobs.us_cities(city_temp))
    temp = run.write("monthly_temperature", jobs.monthly_temperature(city_temp))
    raw = write_stage(fact_raw(spark, d), "raw_entries")
    fact = run.write("entry_fact", jobs.entry_fact_narrow(raw), ["entry_year", "entry_month"])
    run.write("analytical", jobs.analytical_table(fact, ports2, temp))
    run.publish(lambda tables: quality.unique_key(tables["entry_fact"], "fact: cicid twice", ["cicid"]))
    a = releases.read_current(spark, f"{root}/warehouse", "analytical")
    return a.select("i94port_city_code", "city", "state_code", _r6("average_temperature").alias("average_temperature"),
                    _long("entry_year").alias("entry_year"), _long("entry_month").alias("entry_month"),
                    _long("count").alias("count"), _long("rank").alias("rank"))


QUERIES: dict[str, Query] = {
    "analytical_table": analytical_table,
    "climatology": climatology,
    "recent_window_mean": recent_window_mean,
    "month_matrix": month_matrix,
    "matrix_to_series": matrix_to_series,
    "port_regression": port_regression,
    "geo_join": geo_join,
    "geo_distance_haversine": geo_distance_haversine,
    "hemisphere_parse": hemisphere_parse,
    "coordinate_split": coordinate_split,
    "city_state_split": city_state_split,
    "city_state_reparse": city_state_reparse,
    "trim_suffix": trim_suffix,
    "substr_codes": substr_codes,
    "sas_date_roundtrip": sas_date_roundtrip,
    "compact_date_parse": compact_date_parse,
    "stay_date_normalise": stay_date_normalise,
    "month_token": month_token,
    "bulk_cast": bulk_cast,
    "regex_filter": regex_filter,
    "prefix_exclude": prefix_exclude,
    "contains_any_exclude": contains_any_exclude,
    "allow_deny_list": allow_deny_list,
    "length_branches": length_branches,
    "drop_null_rows": drop_null_rows,
    "dropped_rows": dropped_rows,
    "two_key_join": two_key_join,
    "role_lookup": role_lookup,
    "code_lookup": code_lookup,
    "unmatched_codes": unmatched_codes,
    "unmatched_states": unmatched_states,
    "join_recovery": join_recovery,
    "null_audit": null_audit,
    "distinct_rows": distinct_rows_q,
    "dedup_by_key": dedup_by_key,
    "value_profile": value_profile,
    "top_n": top_n,
    "top_n_share": top_n_share,
    "category_share": category_share,
    "demographics_mean": demographics_mean,
    "missing_departure_profile": missing_departure_profile,
    "fill_and_replace": fill_and_replace,
    "keyed_override": keyed_override,
    "quality_counts": quality_counts,
    "port_dimension": port_dimension,
    "fact_clean": fact_clean,
    "retention_audit": retention_audit,
    "missing_histogram": missing_histogram,
    "airport_port_join": airport_port_join,
    "city_temperature_dim": city_temperature_dim,
    "us_cities": us_cities,
    "entity_profiles": entity_profiles,
    "airport_concentration": airport_concentration,
    "sorted_head": sorted_head,
    "csv_roundtrip": csv_roundtrip,
    "delimited_scan": delimited_scan,
    "partitioned_roundtrip": partitioned_roundtrip,
    "multi_file_month_scan": multi_file_month_scan,
    "drifting_month_scan": drifting_month_scan,
    "incremental_month_load": incremental_month_load,
    "json_stage_load": json_stage_load,
    "insert_fact": insert_fact,
    "insert_dimension": insert_dimension,
    "ordered_month_export": ordered_month_export,
    "quarantined_scan": quarantined_scan,
    "distinct_sketch": distinct_sketch,
    "sliced_load": sliced_load,
    "observed_fact_load": observed_fact_load,
    "file_row_counts": file_row_counts,
    "published_release": published_release,
    "gate_counts": gate_counts,
    "full_pipeline": full_pipeline,
}
