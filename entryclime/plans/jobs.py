"""The pipelines: DataFrame-in, DataFrame-out, lazy, no driver collects.

Inputs are the raw sources as DataFrames (see ``entryclime.schemas``), so
one call covers one month or many: the month is a column, never a path
parameter baked into the logic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entryclime.functions import dates, geo, text
from entryclime.operators import aggregates as agg
from entryclime.operators import dedup, filters, joins
from entryclime.operators.dedup import apply_overrides, first_per_key
from entryclime.schemas import ENTRY_FACT

# Fixed values of the cleaning rules (they decide which rows survive).
JUNK_PORT_PREFIXES = ["No PORT Code", "Collapsed"]
RE_EXTRACT_MARKS = ["(BPS)", "#ARPT"]
EXCLUDED_STATE_CODES = ["MX"]
LARGE_AIRPORT = "large_airport"
INTERNATIONAL_WORD = "International"
# International airports whose names lack the word, and smaller second airports dropped
# so that a city is not counted twice.
AIRPORT_ALLOW_IDENTS = ["KIAH", "KOMA", "KSNA", "KDTW"]
AIRPORT_DENY_IDENTS = ["KLCK", "KMDW", "KSFB", "KBFI"]
CLIMATE_COUNTRY = "United States"
CLIMATE_WINDOW = ("2003-09-01", "2013-09-01")
MATCH_DISTANCE_KM = 180.0


# --------------------------------------------------------------------- M1 ports
def parse_city_state(df: DataFrame, col: str, city: str = "city", state: str = "state_code") -> DataFrame:
    """Add ``city`` and ``state`` parsed from ``'CITY, ST'`` text in ``col``.

    Last token = state, the rest (minus one trailing comma) = city. When the
    last token is a marker such as ``(BPS)``, the state is re-read after the
    first ``', '`` of the city text and the city is cut there. Built in steps
    so every intermediate is computed once (Catalyst keeps non-cheap columns
    that are used several times in their own projection).
    """
    tmp = ["_cs_city0", "_cs_state0", "_cs_state2", "_cs_use2"]
    out = df.withColumns({"_cs_city0": text.strip_trailing_comma(text.all_but_last_token(col)),
                          "_cs_state0": text.last_token(col)})
    out = out.withColumn("_cs_state2", text.state_after_comma("_cs_city0"))
    out = out.withColumn("_cs_use2", F.col("_cs_state0").isin(RE_EXTRACT_MARKS) & (F.length("_cs_state2") == 2))
    out = out.withColumns({
        city: F.when(F.col("_cs_use2"), text.city_before_comma("_cs_city0")).otherwise(F.col("_cs_city0")),
        state: F.when(F.col("_cs_use2"), F.col("_cs_state2")).otherwise(F.col("_cs_state0")),
    })
    return out.drop(*tmp)


def port_dimension(code_book: DataFrame, states: DataFrame, overrides: DataFrame | None = None,
                   code: str = "code", value: str = "value") -> DataFrame:
    """Port code book ``(code, 'CITY, ST')`` -> ``(i94port_code, city, state_code, state_name)``.

    One pass with ``when`` instead of split/patch/concat branches:
    last token = state; if it is a marker such as ``(BPS)`` the state is
    re-read after the first ``', '`` of the city text. ``overrides``
    ``(i94port_code, city, state_code)`` replace manual row patches.
    """
    cb = code_book.select(text.remove_quotes(code).alias("i94port_code"),
                          text.remove_quotes(value).alias("city_state"))
    cb = filters.exclude_prefixes(cb, "city_state", JUNK_PORT_PREFIXES)
    # Through a one-element array: the filters below apply to its result and are not pushed back into
    # the parsing, which would then run once more for each of them.
    parsed = parse_city_state(cb, "city_state").select("i94port_code", F.inline(F.array(F.struct("city", "state_code"))))
    if overrides is not None:
        parsed = apply_overrides(parsed, overrides, "i94port_code", ["city", "state_code"])
    parsed = parsed.where(F.length("state_code") == 2).select(
        "i94port_code", text.text_after_dash("city").alias("city"), "state_code")
    parsed = parsed.where(~F.col("state_code").isin(EXCLUDED_STATE_CODES))
    st = states.select(text.remove_quotes("state_code").alias("_sc"),
                       text.remove_quotes("state_name").alias("state_name"))
    out = parsed.join(st, parsed["state_code"] == st["_sc"], "inner").drop("_sc")
    return out.distinct()


def unmatched_state_codes(ports_raw: DataFrame, states: DataFrame) -> DataFrame:
    """Two-letter codes of the port book missing from the state list (NOT EXISTS)."""
    codes = ports_raw.select("state_code").distinct()
    return joins.unmatched(codes, states.select(F.col("state_code").alias("_sc")), "state_code", "_sc")


# ------------------------------------------------------------ M2-M4 airports
def airport_port_join(airports: DataFrame, ports: DataFrame,
                      allow: list[str] = AIRPORT_ALLOW_IDENTS, deny: list[str] = AIRPORT_DENY_IDENTS,
                      zero_lon: float = geo.JFK_LONGITUDE, zero_lat: float = geo.JFK_LATITUDE,
                      default_elevation: float = geo.DEFAULT_ELEVATION_FT) -> DataFrame:
    """US large airports matched to ports by (lower-cased city, state); one row per ident."""
    a = airports.where(F.col("iso_country") == "US")
    xy = geo.split_coordinates("coordinates")
    a = a.select(
        "ident", "type", "name", "elevation_ft", "iso_country",
        F.lower("municipality").alias("municipality"),
        xy["longitude"].alias("longitude"), xy["latitude"].alias("latitude"),
        text.right_chars("iso_region", 2).alias("state_code"),
    ).where(F.col("municipality").isNotNull())
    p = ports.select("i94port_code", "state_name", F.col("state_code").alias("_p_state"),
                     F.lower("city").alias("city"))
    j = a.join(p, (a["municipality"] == p["city"]) & (a["state_code"] == p["_p_state"]), "inner").drop("_p_state")
    j = j.where(F.col("type") == LARGE_AIRPORT).select(
        "ident", "type", "name", "iso_country", "municipality", "i94port_code", "state_name",
        "state_code", "city",
        F.coalesce(F.col("elevation_ft").try_cast("double"), F.lit(default_elevation)).alias("elevation_ft"),
        geo.replace_zero(F.col("longitude"), zero_lon).alias("longitude"),
        geo.replace_zero(F.col("latitude"), zero_lat).alias("latitude"),
    )
    j = filters.allow_deny(j, F.col("name").contains(INTERNATIONAL_WORD),
                           allow=F.col("ident").isin(allow), deny=F.col("ident").isin(deny))
    return first_per_key(j, ["ident"], order=["i94port_code"])


def airport_dimension(airport_port: DataFrame) -> DataFrame:
    return airport_port.select(
        F.col("ident").alias("airport_id"), F.col("type").alias("airport_type"),
        F.col("name").alias("airport_name"), "i94port_code", "state_code", "elevation_ft",
        F.col("longitude").alias("airport_longitude"), F.col("latitude").alias("airport_latitude"),
    )


def port_dimension_v2(airport_port: DataFrame) -> DataFrame:
    return airport_port.select("i94port_code", "city", "state_code").distinct()


# ------------------------------------------------------- M5-M7 temperatures
def city_climatology(temps: DataFrame, country: str = CLIMATE_COUNTRY,
                     window: tuple[str, str] = CLIMATE_WINDOW) -> DataFrame:
    """Mean temperature per (city, month, raw lat, raw lon) over a half-open date window."""
    t = temps.where(F.col("Country") == country).select(
        F.col("dt"), F.col("AverageTemperature").try_cast("double").alias("average_temperature"),
        F.col("City").alias("city"), F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
    ).where(F.col("average_temperature").isNotNull())
    d = dates.iso_text_to_date("dt")
    # ISO text orders like its dates, so the same window on the raw text reaches the scan.
    t = t.where((F.col("dt") >= window[0]) & (F.col("dt") < window[1]))
    t = t.withColumn("month", F.month(d)).where(dates.half_open(d, *window))
    g = t.groupBy("city", "month", "latitude", "longitude").agg(
        F.avg("average_temperature").alias("average_temperature"))
    return g.select("city", "month", "average_temperature",
                    geo.latitude_degrees("latitude").alias("latitude"),
                    geo.longitude_degrees("longitude").alias("longitude"))


def city_temperature(climatology: DataFrame, gazetteer: DataFrame,
                     max_km: float = MATCH_DISTANCE_KM, method: str = "lambert") -> DataFrame:
    """Climatology points matched to gazetteer cities of the same name within ``max_km``.

    Output ``(city, month, average_temperature, state_id, state_name, lat, lng)``,
    distinct. The climatology side is the smaller one and is replicated to
    neighbouring grid cells inside ``proximity_join``.
    """
    g = gazetteer.select(F.col("city").alias("g_city"), "state_id", "state_name",
                         F.col("lat").try_cast("double").alias("lat"),
                         F.col("lng").try_cast("double").alias("lng"))
    j = joins.proximity_join(g, climatology, [("g_city", "city")], ("lat", "lng"),
                             ("latitude", "longitude"), max_km, method)
    return j.select("city", "month", "average_temperature", "state_id", "state_name", "lat", "lng").distinct()


def us_cities(city_temp: DataFrame) -> DataFrame:
    return city_temp.select("city", "state_id", "state_name", F.col("lat").alias("latitude"),
                            F.col("lng").alias("longitude")).distinct()


def monthly_temperature(city_temp: DataFrame) -> DataFrame:
    return city_temp.select("city", "state_id", "month", "average_temperature")


# -------------------------------------------------------------------- M8 fact
FACT_COLUMNS = ENTRY_FACT.names
FACT_INT_COLUMNS = ["entry_year", "entry_month", "citizenship_of_country_id", "resident_of_country_id",
                    "visa_category_id", "entry_mode_id", "age"]


def entry_fact(raw: DataFrame, stay_pattern: str = dates.STAY_PATTERN_STRICT) -> DataFrame:
    """Raw monthly records -> the typed fact, one row per ``cicid``.

    Same gates as the monthly job (allowed-stay present and matching the
    pattern, file date present, every kept column non-null) with two fixes:
    ``admission_number`` is a bigint (11-digit values), and the surviving row
    of a duplicated ``cicid`` is deterministic.
    """
    fact = typed_entries(raw.where(raw_entry_gate(stay_pattern)))
    # A row with a null gives no candidate, and a key without a candidate no row. As a filter below the aggregate
    # the same condition would compute every typed column twice, and a single "no nulls in these 18" predicate makes
    # the optimizer derive a constraint for every subset of the columns it can rename.
    rest = [c for c in FACT_COLUMNS if c != "cicid"]
    candidate = F.when(filters.all_present(FACT_COLUMNS), F.struct(*rest))
    first = fact.groupBy("cicid").agg(F.min(candidate).alias("_row")).where(F.col("_row").isNotNull())
    return first.select("cicid", "_row.*")


def entry_fact_narrow(raw: DataFrame, stay_pattern: str = dates.STAY_PATTERN_STRICT) -> DataFrame:
    """``entry_fact`` over stored records, which exchanges only the rows whose ``cicid`` may repeat.

    A ``cicid`` that occurs once needs no exchange of its 18 columns: its row is kept or dropped where it is read.
    """
    gated = raw.where(raw_entry_gate(stay_pattern)).withColumn("_id", F.col("cicid").try_cast("bigint"))
    alone, shared = dedup.split_repeated(gated, ["_id"])
    # Behind a generator, so that no constraint is derived from the 18 null checks (see ``entry_fact``).
    row = F.when(filters.all_present(FACT_COLUMNS), F.struct(*FACT_COLUMNS))
    kept = typed_entries(alone).select(F.inline(F.filter(F.array(row), lambda r: r.isNotNull())))
    return kept if shared is None else kept.unionByName(entry_fact(shared, stay_pattern))


def raw_entry_gate(stay_pattern: str = dates.STAY_PATTERN_STRICT) -> Column:
    """Rows of the raw records that the monthly job lets in."""
    return _gate("dtaddto", "dtadfile", stay_pattern)


def entry_gate(stay_pattern: str = dates.STAY_PATTERN_STRICT) -> Column:
    """``raw_entry_gate`` on typed records (a file date that parses was present)."""
    return _gate("allow_to_stay_date", "add_to_file_date", stay_pattern)


def _gate(stay: str, filed: str, stay_pattern: str) -> Column:
    return (F.col(stay).isNotNull() & (F.col(stay) != "") & dates.stay_pattern_ok(stay, stay_pattern)
            & F.col(filed).isNotNull())


def typed_entries(raw: DataFrame) -> DataFrame:
    """The raw records with the fact's names and types, no row dropped."""
    return raw.select(
        F.col("cicid").try_cast("bigint").alias("cicid"),
        F.col("admnum").try_cast("bigint").alias("admission_number"),
        F.col("i94port").alias("i94port_city_code"),
        F.col("i94addr").alias("destination_state_code"),
        F.col("dtaddto").alias("allow_to_stay_date"),
        F.col("airline").alias("airline_code"),
        F.col("fltno").alias("flight_number"),
        F.col("visatype").alias("visa_type"),
        dates.sas_to_date("arrdate").alias("arrival_date"),
        dates.sas_to_date("depdate").alias("departure_date"),
        dates.compact_to_date("dtadfile").alias("add_to_file_date"),
        F.col("i94yr").try_cast("int").alias("entry_year"),
        F.col("i94mon").try_cast("int").alias("entry_month"),
        F.col("i94cit").try_cast("int").alias("citizenship_of_country_id"),
        F.col("i94res").try_cast("int").alias("resident_of_country_id"),
        F.col("i94visa").try_cast("int").alias("visa_category_id"),
        F.col("i94mode").try_cast("int").alias("entry_mode_id"),
        F.col("i94bir").try_cast("int").alias("age"),
    )


def retention(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """(n_in, n_out, retention) of any cleaning step; no rows in gives a null retention.

    Counts both frames, so their common source is read twice; ``entry_retention`` reads it once.
    """
    both = raw.select(F.lit(1).alias("_in"), F.lit(0).alias("_out")).unionAll(
        cleaned.select(F.lit(0).alias("_in"), F.lit(1).alias("_out")))
    return _retained(both.agg(F.sum("_in").alias("n_in"), F.sum("_out").alias("n_out")))


def _retained(counts: DataFrame) -> DataFrame:
    n_in, n_out = (F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_in", "n_out"))
    return counts.select(n_in.alias("n_in"), n_out.alias("n_out"), F.try_divide(n_out, n_in).alias("retention"))


def entry_retention(raw: DataFrame, stay_pattern: str = dates.STAY_PATTERN_STRICT) -> DataFrame:
    """``retention`` of ``entry_fact`` in one read: rows and kept rows per ``cicid``, then their sums."""
    typed = typed_entries(raw)
    kept = entry_gate(stay_pattern) & filters.all_present(FACT_COLUMNS)
    per_key = typed.groupBy("cicid").agg(F.count(F.lit(1)).alias("_n"),
                                         F.max(F.coalesce(kept, F.lit(False)).cast("long")).alias("_kept"))
    return _retained(per_key.agg(F.sum("_n").alias("n_in"), F.sum("_kept").alias("n_out")))


# -------------------------------------------------------- M9 analytical table
def analytical_table(fact: DataFrame, ports: DataFrame, temperature: DataFrame,
                     port_key: str = "i94port_city_code") -> DataFrame:
    """Travellers per (port, city, state, temperature, year, month) with a rank by count.

    Aggregate before join: the fact is counted per (port, year, month) with a
    partial aggregate first (hot ports fold inside each task), then the small
    port and temperature dimensions are joined to the counts, and a final
    ``sum`` re-groups in case a dimension repeats a row -- the result equals
    joining row by row and counting afterwards.
    """
    counts = fact.groupBy(F.col(port_key).alias("_port"), "entry_year", "entry_month").agg(
        F.count(F.lit(1)).alias("_n"))
    p = ports.select(F.col("i94port_code").alias("_pcode"), "city", "state_code")
    t = temperature.select(F.lower("city").alias("_tcity"), F.col("state_id").alias("_tstate"),
                           F.col("month").alias("_tmonth"), "average_temperature")
    j = counts.join(p, counts["_port"] == p["_pcode"], "inner")
    j = j.join(t, (j["city"] == t["_tcity"]) & (j["state_code"] == t["_tstate"])
               & (j["entry_month"] == t["_tmonth"]), "inner")
    g = j.groupBy(F.col("_port").alias(port_key), "city", "state_code", "average_temperature",
                  "entry_year", "entry_month").agg(F.sum("_n").alias("count"))
    return agg.ranked(g, ["entry_year", "entry_month"], [F.desc("count"), F.asc(port_key)])


def join_recovery(fact: DataFrame, ports: DataFrame, temperature: DataFrame,
                  port_key: str = "i94port_city_code") -> DataFrame:
    """Share of fact rows (already matched to a port) that also find a temperature, in one pass."""
    counts = fact.groupBy(F.col(port_key).alias("_port"), "entry_month").agg(F.count(F.lit(1)).alias("_n"))
    p = ports.select(F.col("i94port_code").alias("_pcode"), "city", "state_code")
    t = (temperature.select(F.lower("city").alias("_tcity"), F.col("state_id").alias("_tstate"),
                            F.col("month").alias("_tmonth")).distinct().withColumn("_hit", F.lit(1)))
    j = counts.join(p, counts["_port"] == p["_pcode"], "inner")
    j = j.join(t, (j["city"] == t["_tcity"]) & (j["state_code"] == t["_tstate"])
               & (j["entry_month"] == t["_tmonth"]), "left")
    return j.agg(F.sum("_n").cast("long").alias("n_rows"),
                 F.sum(F.when(F.col("_hit") == 1, F.col("_n")).otherwise(0)).cast("long").alias("n_recovered")
                 ).withColumn("recovery", F.col("n_recovered") / F.col("n_rows"))


# ------------------------------------------------------- M10 matrix + linear fit
def port_month_matrix(analytical: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Ports x 12 months of (temperature, count); only ports present in every month."""
    keys = keys or ["i94port_city_code", "city", "state_code", "entry_year"]
    return agg.month_matrix(analytical, keys, "entry_month",
                            {"average_temperature": F.max("average_temperature"), "count": F.sum("count")})


def port_series(matrix: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["i94port_city_code", "city", "state_code", "entry_year"]
    return agg.matrix_to_long(matrix, keys, ["average_temperature", "count"], "entry_month")


def complete_series(analytical: DataFrame, keys: list[str] | None = None, month_col: str = "entry_month",
                    months: list[int] = agg.MONTHS) -> DataFrame:
    """Long rows of the keys that have every month (what the wide matrix keeps), without a pivot.

    One window per key ORs a bit per month present and keeps the keys whose
    mask has every month's bit: the input is read once, with no join back.
    The input is already aggregated (about one row per key and month), so a
    window partition holds a dozen rows however skewed the raw data was.
    """
    keys = keys or ["i94port_city_code", "city", "state_code", "entry_year"]
    full = sum(1 << m for m in months)
    bit = F.expr(f"shiftleft(CAST(1 AS BIGINT), CAST(`{month_col}` AS INT))")
    seen = F.bit_or(F.when(F.col(month_col).isin(months), bit).otherwise(F.lit(0).cast("long"))
                    ).over(Window.partitionBy(*keys))
    return analytical.withColumn("_months", seen).where(F.col("_months") == F.lit(full)).drop("_months")


def port_regression(series: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Linear fit of count on temperature per port."""
    return agg.linear_fit(series, keys or ["i94port_city_code"], "average_temperature", "count")


# ---------------------------------------------------------- M11-M15 profiles
def visa_stay_profile(fact: DataFrame, visa: str = "F1", token: str = dates.DURATION_OF_STATUS,
                      visa_col: str = "visa_type", stay_col: str = "allow_to_stay_date") -> DataFrame:
    """Per visa type: rows, rows with the ``D/S`` token, and that share."""
    is_tok = F.col(stay_col) == token
    return fact.groupBy(visa_col).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(is_tok).cast("long").alias("n_token"),
        agg.share(is_tok).alias("token_share"),
    )


def counts_by(df: DataFrame, key: str | Column, name: str | None = None) -> DataFrame:
    """Value counts of one column, nulls excluded (the pandas convention)."""
    k = F.col(key) if isinstance(key, str) else key
    return df.where(k.isNotNull()).groupBy(k.alias(name) if name else k).agg(F.count(F.lit(1)).alias("count"))


def concentration(fact: DataFrame, key: str, n: int = 25) -> DataFrame:
    """Top ``n`` values of ``key`` by rows, with the share of all rows they cover."""
    c = fact.groupBy(key).agg(F.count(F.lit(1)).alias("count"))
    return agg.top_n_share(c, n, "count", [F.desc("count"), F.asc(key)])


def top_profiles(df: DataFrame, keys: list[str], n: int = 20) -> DataFrame:
    """Long table (dimension, value, count, rank) with the top ``n`` values of each key.

    One pass: each row gives one (dimension, value) pair per key, all keys are
    counted by one aggregate (partial inside each task), and a task keeps only
    its own top ``n`` of a dimension before the ranks are merged.
    """
    pairs = F.array(*[F.struct(F.lit(k).alias("dimension"), F.col(k).cast("string").alias("value")) for k in keys])
    counts = df.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("count"))
    top = agg.top_n_by(counts, "dimension", n, [F.desc("count"), F.asc("value")])
    return top.select("dimension", "value", "count", "rank")


def airport_concentration(fact: DataFrame, airports: DataFrame, n: int = 25, port_key: str = "i94port_city_code",
                          state_key: str = "destination_state_code") -> DataFrame:
    """Top ``n`` ports and top ``n`` destination states of the fact joined to the airport table.

    Long rows (dimension, value, count, rank, top_share). A port with several
    airports counts once per airport, as the row join does; the fact is counted
    per (port, state) and the airports per port before they meet.
    """
    counts = fact.groupBy(F.col(port_key).alias("_port"), F.col(state_key).alias("_state")).agg(
        F.count(F.lit(1)).alias("_rows"))
    fan = airports.groupBy(F.col("i94port_code").alias("_code")).agg(F.count(F.lit(1)).alias("_airports"))
    joined = counts.join(fan, F.col("_port") == F.col("_code")).withColumn("_n", F.col("_rows") * F.col("_airports"))
    pairs = F.array(F.struct(F.lit("port").alias("dimension"), F.col("_port").cast("string").alias("value")),
                    F.struct(F.lit("state").alias("dimension"), F.col("_state").cast("string").alias("value")))
    values = joined.select("_n", F.inline(pairs)).groupBy("dimension", "value").agg(F.sum("_n").alias("count"))
    total = Window.partitionBy("dimension")
    shared = agg.ranked(values, ["dimension"], [F.desc("count"), F.asc("value")]).withColumn(
        "_all", F.sum("count").over(total)).where(F.col("rank") <= n)
    return shared.select("dimension", "value", "count", "rank",
                         F.try_divide(F.sum("count").over(total), F.col("_all")).alias("top_share"))
