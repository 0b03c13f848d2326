"""One named test per source quirk that is kept or fixed."""

import datetime as dt

import pytest
from pyspark.sql.types import LongType

from entryclime import schemas
from entryclime.functions import dates, geo, text
from entryclime.operators import quality
from entryclime.plans import jobs

BASE = dict(cicid=1.0, i94yr=2016.0, i94mon=4.0, i94cit=209.0, i94res=209.0, i94port="NYC", arrdate=20573.0,
            i94mode=1.0, i94addr="NY", depdate=20580.0, i94bir=30.0, i94visa=2.0, count=1.0, dtadfile="20160422",
            dtaddto="10222016", airline="AA", admnum=55425279233.0, fltno="00100", visatype="B2")


def _raw(spark, rows):
    cols = [f.name for f in schemas.RAW_ENTRIES.fields]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schemas.RAW_ENTRIES)


def _one(spark, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl)


def _temps(spark, rows):
    return spark.createDataFrame([(d, v, "0.1", city, country, "39.80N", "89.64W") for d, v, city, country in rows],
                                 schemas.GLOBAL_CITY_TEMPERATURES)


def _airports(spark, rows):
    cols = [f.name for f in schemas.AIRPORT_CODES.fields]

    def ap(ident, name, muni="New York", region="US-NY", coords="-73.87, 40.77", elev="10"):
        d = dict(ident=ident, type="large_airport", name=name, elevation_ft=elev, continent="NA",
                 iso_country="US", iso_region=region, municipality=muni, coordinates=coords)
        return tuple(d.get(c) for c in cols)

    return spark.createDataFrame([ap(*r) if isinstance(r, tuple) else ap(**r) for r in rows], schemas.AIRPORT_CODES)


def test_q1_admission_number_is_bigint(spark):
    fact = jobs.entry_fact(_raw(spark, [BASE]))
    assert fact.schema["admission_number"].dataType == LongType()
    assert fact.first().admission_number == 55425279233


def test_q2_climate_window_is_half_open(spark):
    t = _temps(spark, [("2003-09-01", "1.0", "Springfield", "United States"),
                       ("2013-09-01", "100.0", "Springfield", "United States")])
    got = {r.month: r.average_temperature for r in jobs.city_climatology(t).collect()}
    assert got == {9: pytest.approx(1.0)}  # 2013-09-01 itself is outside


def test_q3_sas_day_zero_is_null(spark):
    df = spark.createDataFrame([(0.0,), (None,), (20573.0,)], "d double")
    got = [r[0] for r in df.select(dates.sas_to_date("d")).collect()]
    assert got == [None, None, dt.date(2016, 4, 29)]


def test_q4_stay_regex_is_start_anchored_and_case_insensitive(spark):
    cases = {"10222016": True, "10222016junk": True, "d/s": True, "19392016": True,
             "10222020": False, "x10222016": False, None: False}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.ok for r in df.select("s", dates.stay_pattern_ok("s").alias("ok")).collect()}
    assert got == cases


def test_q5_loose_stay_pattern_is_a_parameter(spark):
    raw = _raw(spark, [{**BASE, "dtaddto": "10222020"}])
    assert jobs.entry_fact(raw).count() == 0
    assert jobs.entry_fact(raw, stay_pattern=dates.STAY_PATTERN_LOOSE).count() == 1


def test_q6_fact_drops_rows_with_any_null(spark):
    raw = _raw(spark, [BASE, {**BASE, "cicid": 2.0, "airline": None}, {**BASE, "cicid": 3.0, "depdate": None}])
    assert [r.cicid for r in jobs.entry_fact(raw).collect()] == [1]


def test_q7_duplicate_cicid_survivor_is_deterministic(spark):
    rows = [{**BASE, "airline": a} for a in ("ZZ", "AA", "MM")]
    seen = set()
    for order in (rows, rows[::-1]):
        raw = _raw(spark, order).repartition(3)
        seen.add(jobs.entry_fact(raw).first().airline_code)
    assert seen == {"AA"}


def test_q8_airport_matching_two_ports_keeps_smallest_code(spark):
    ports = spark.createDataFrame([("NYC", "NEW YORK", "NY", "NEW YORK"), ("JFK", "NEW YORK", "NY", "NEW YORK")],
                                  schemas.PORT_DIM)
    got = jobs.airport_port_join(_airports(spark, [("KJFK", "Kennedy International")]), ports).collect()
    assert [(r.ident, r.i94port_code) for r in got] == [("KJFK", "JFK")]


def test_q9_allow_list_and_rule_give_one_row(spark):
    ports = spark.createDataFrame([("HOU", "HOUSTON", "TX", "TEXAS")], schemas.PORT_DIM)
    a = _airports(spark, [dict(ident="KIAH", name="Houston International", muni="Houston", region="US-TX")])
    assert jobs.airport_port_join(a, ports).count() == 1


def test_q10_airport_dimension_has_renamed_columns(spark):
    ports = spark.createDataFrame([("NYC", "NEW YORK", "NY", "NEW YORK")], schemas.PORT_DIM)
    dim = jobs.airport_dimension(jobs.airport_port_join(_airports(spark, [("KJFK", "JFK International")]), ports))
    assert dim.columns == ["airport_id", "airport_type", "airport_name", "i94port_code", "state_code",
                           "elevation_ft", "airport_longitude", "airport_latitude"]


def test_q11_overrides_are_keyed_and_add_no_rows(spark):
    book = spark.createDataFrame([("'ALC'", "'ALCAN, AK'")], "code string, value string")
    states = spark.createDataFrame([("'AK'", "'ALASKA'")], "state_code string, state_name string")
    o = spark.createDataFrame([("ALC", "ALCAN BORDER", None), ("ZZZ", "GHOST", "AK")],
                              "i94port_code string, city string, state_code string")
    got = [tuple(r) for r in jobs.port_dimension(book, states, o).collect()]
    assert got == [("ALC", "ALCAN BORDER", "AK", "ALASKA")]


def test_q12_q13_zero_coordinates_and_missing_elevation(spark):
    ports = spark.createDataFrame([("NYC", "NEW YORK", "NY", "NEW YORK")], schemas.PORT_DIM)
    a = _airports(spark, [dict(ident="KJFK", name="JFK International", coords="0, 0", elev=None)])
    r = jobs.airport_port_join(a, ports).first()
    assert (r.longitude, r.latitude, r.elevation_ft) == (geo.JFK_LONGITUDE, geo.JFK_LATITUDE,
                                                          geo.DEFAULT_ELEVATION_FT)


def test_q14_temperature_to_gazetteer_join_is_case_sensitive(spark):
    t = _temps(spark, [("2005-01-01", "10.0", "springfield", "United States")])
    gaz = spark.createDataFrame([("Springfield", "IL", "Illinois", "39.80", "-89.64")], schemas.US_CITIES_SIMPLEMAP)
    assert jobs.city_temperature(jobs.city_climatology(t), gaz).count() == 0


def test_q15_repeated_temperature_rows_count_like_a_row_join(spark):
    fact = spark.createDataFrame([("BOS", 2016, 4)] * 2, "i94port_city_code string, entry_year int, entry_month int")
    ports = spark.createDataFrame([("BOS", "boston", "MA")], "i94port_code string, city string, state_code string")
    temp = spark.createDataFrame([("Boston", "MA", 4, 9.0)] * 2,
                                 "city string, state_id string, month int, average_temperature double")
    assert [r["count"] for r in jobs.analytical_table(fact, ports, temp).collect()] == [4]


def test_q16_rank_ties_break_on_port_code(spark):
    fact = spark.createDataFrame([("SEA", 2016, 4), ("BOS", 2016, 4)],
                                 "i94port_city_code string, entry_year int, entry_month int")
    ports = spark.createDataFrame([("BOS", "boston", "MA"), ("SEA", "seattle", "WA")],
                                  "i94port_code string, city string, state_code string")
    temp = spark.createDataFrame([("Boston", "MA", 4, 9.0), ("Seattle", "WA", 4, 8.0)],
                                 "city string, state_id string, month int, average_temperature double")
    got = sorted((r["rank"], r.i94port_city_code) for r in jobs.analytical_table(fact, ports, temp).collect())
    assert got == [(1, "BOS"), (2, "SEA")]


def test_q17_matrix_keeps_ports_with_every_month(spark):
    rows = [("A", "a", "X", 2016, m, 1.0, 3) for m in range(1, 13)]
    rows += [("B", "b", "Y", 2016, m, 1.0, 3) for m in range(1, 12)]
    df = spark.createDataFrame(rows, "i94port_city_code string, city string, state_code string, entry_year int, "
                                     "entry_month int, average_temperature double, count int")
    assert [r.i94port_city_code for r in jobs.port_month_matrix(df).collect()] == ["A"]


def test_q18_value_counts_skip_null_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(tuple(r) for r in jobs.counts_by(df, "k").collect()) == [("a", 2)]


def test_q22_gate_names_the_failed_table(spark):
    checks = quality.row_counts({"fact": spark.range(0)})
    with pytest.raises(quality.QualityCheckError, match=r"fact \(0 rows\)"):
        quality.assert_quality(checks)


def test_q23_csv_check_lists_tables_at_check_time(spark, tmp_path):
    spark.range(3).write.option("header", True).csv(str(tmp_path / "ports.csv"))
    spark.range(0).write.option("header", True).csv(str(tmp_path / "notes"))
    tables = quality.csv_tables(spark, str(tmp_path), sorted(p.name for p in tmp_path.iterdir()))
    assert list(tables) == ["ports.csv"]
    assert quality.row_counts(tables).first().n_rows == 3


def test_q24_code_book_cells_are_trimmed(spark):
    assert _one(spark, "'SAN JUAN, PR  '").select(text.remove_quotes("x")).first()[0] == "SAN JUAN, PR"


def test_q25_one_token_city_is_null_safe(spark):
    book = spark.createDataFrame([("'ONE'", "'SINGLETOKEN'"), ("'ALC'", "'ALCAN, AK'")], "code string, value string")
    states = spark.createDataFrame([("'AK'", "'ALASKA'")], "state_code string, state_name string")
    assert [r.i94port_code for r in jobs.port_dimension(book, states).collect()] == ["ALC"]


def test_q26_entry_month_comes_from_the_data(spark):
    raw = _raw(spark, [BASE, {**BASE, "cicid": 2.0, "i94mon": 9.0}])
    got = sorted((r.cicid, r.entry_month) for r in jobs.entry_fact(raw).collect())
    assert got == [(1, 4), (2, 9)]
