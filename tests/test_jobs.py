"""Pipeline jobs on small inputs shaped like the raw sources (FIXTURES.md)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from entryclime import schemas
from entryclime.plans import jobs


def test_port_dimension_edge_rows(spark):
    book = spark.createDataFrame([
        ("'ALC'", "'ALCAN, AK'"),
        ("'SJU'", "'SAN JUAN, PR  '"),
        ("'BPS'", "'DERBY, VT (BPS)'"),
        ("'ARP'", "'SOME CITY, NY #ARPT'"),
        ("'DSH'", "'X - BORDER TOWN, TX'"),
        ("'NOP'", "'No PORT Code (XXX)'"),
        ("'COL'", "'Collapsed (BOS) 06/15'"),
        ("'ONE'", "'SINGLETOKEN'"),
        ("'MEX'", "'TIJUANA, MX'"),
        ("'UNK'", "'NOWHERE, ZZ'"),
    ], "code string, value string")
    states = spark.createDataFrame([("'AK'", "'ALASKA'"), ("'PR'", "'PUERTO RICO'"), ("'VT'", "'VERMONT'"),
                                    ("'NY'", "'NEW YORK'"), ("'TX'", "'TEXAS'")],
                                   "state_code string, state_name string")
    got = sorted(tuple(r) for r in jobs.port_dimension(book, states).collect())
    assert got == [
        ("ALC", "ALCAN", "AK", "ALASKA"),
        ("ARP", "SOME CITY", "NY", "NEW YORK"),
        ("BPS", "DERBY", "VT", "VERMONT"),
        ("DSH", "BORDER TOWN", "TX", "TEXAS"),
        ("SJU", "SAN JUAN", "PR", "PUERTO RICO"),
    ]


def test_port_dimension_overrides(spark):
    book = spark.createDataFrame([("'DC'", "'DIST. OF COLUMBIA'")], "code string, value string")
    states = spark.createDataFrame([("'DC'", "'DISTRICT OF COLUMBIA'")], "state_code string, state_name string")
    o = spark.createDataFrame([("DC", "DIST. OF COLUMBIA", "DC")], "i94port_code string, city string, state_code string")
    got = [tuple(r) for r in jobs.port_dimension(book, states, o).collect()]
    assert got == [("DC", "DIST. OF COLUMBIA", "DC", "DISTRICT OF COLUMBIA")]


def _raw(spark, rows):
    cols = [f.name for f in schemas.RAW_ENTRIES.fields]
    full = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(full, schemas.RAW_ENTRIES)


BASE = dict(cicid=1.0, i94yr=2016.0, i94mon=4.0, i94cit=209.0, i94res=209.0, i94port="NYC", arrdate=20573.0,
            i94mode=1.0, i94addr="NY", depdate=20580.0, i94bir=30.0, i94visa=2.0, count=1.0, dtadfile="20160422",
            dtaddto="10222016", airline="AA", admnum=55425279233.0, fltno="00100", visatype="B2")


def test_entry_fact_rules(spark):
    rows = [
        BASE,
        {**BASE, "cicid": 2.0, "dtaddto": "D/S", "visatype": "F1"},
        {**BASE, "cicid": 3.0, "dtaddto": "x10222016"},          # rejected by the pattern
        {**BASE, "cicid": 4.0, "depdate": None},                  # no departure -> dropped
        {**BASE, "cicid": 5.0, "dtadfile": "2016042x"},           # malformed file date -> dropped
        {**BASE, "cicid": 6.0, "dtaddto": ""},                    # empty stay -> dropped
        {**BASE, "cicid": 1.0, "airline": "ZZ"},                  # duplicate cicid, larger row
    ]
    fact = jobs.entry_fact(_raw(spark, rows))
    got = {r.cicid: r for r in fact.collect()}
    assert sorted(got) == [1, 2]
    r1 = got[1]
    assert r1.admission_number == 55425279233  # above int32: kept as bigint
    assert r1.airline_code == "AA"              # deterministic survivor
    assert r1.arrival_date == dt.date(2016, 4, 29) and r1.add_to_file_date == dt.date(2016, 4, 22)
    assert got[2].allow_to_stay_date == "D/S"
    assert fact.columns == jobs.FACT_COLUMNS


def test_analytical_aggregate_before_join_equals_row_join(spark):
    fact = spark.createDataFrame([("NYC", 2016, 4)] * 5 + [("BOS", 2016, 4)] * 2 + [("SEA", 2016, 4)],
                                 "i94port_city_code string, entry_year int, entry_month int")
    ports = spark.createDataFrame([("NYC", "new york", "NY"), ("BOS", "boston", "MA"), ("SEA", "seattle", "WA")],
                                  "i94port_code string, city string, state_code string")
    # two temperature rows for boston (two gazetteer points), none for seattle
    temp = spark.createDataFrame([("New York", "NY", 4, 12.0), ("Boston", "MA", 4, 9.0), ("Boston", "MA", 4, 9.0)],
                                 "city string, state_id string, month int, average_temperature double")
    got = sorted((r.i94port_city_code, r["count"], r["rank"]) for r in jobs.analytical_table(fact, ports, temp).collect())
    # row-grain join then count gives 4 for boston (2 rows x 2 matches), 5 for new york
    assert got == [("BOS", 4, 2), ("NYC", 5, 1)]


def test_city_temperature_distance_filter(spark):
    temps = spark.createDataFrame([
        ("2005-01-01", "10.0", "0.1", "Springfield", "United States", "39.80N", "89.64W"),
        ("2006-01-01", "12.0", "0.1", "Springfield", "United States", "39.80N", "89.64W"),
        ("2013-09-01", "99.0", "0.1", "Springfield", "United States", "39.80N", "89.64W"),  # outside window
        ("2005-01-01", None, "0.1", "Springfield", "United States", "39.80N", "89.64W"),
        ("2005-01-01", "5.0", "0.1", "Paris", "France", "48.86N", "2.35E"),
    ], schemas.GLOBAL_CITY_TEMPERATURES)
    gaz = spark.createDataFrame([("Springfield", "IL", "Illinois", "39.80", "-89.64"),
                                 ("Springfield", "MA", "Massachusetts", "42.10", "-72.59")],
                                schemas.US_CITIES_SIMPLEMAP)
    clim = jobs.city_climatology(temps)
    got = [tuple(r) for r in jobs.monthly_temperature(jobs.city_temperature(clim, gaz)).collect()]
    assert got == [("Springfield", "IL", 1, pytest.approx(11.0))]


def test_airport_port_join_rules(spark):
    cols = [f.name for f in schemas.AIRPORT_CODES.fields]

    def ap(ident, typ, name, muni, region, coords, elev="10"):
        d = dict(ident=ident, type=typ, name=name, elevation_ft=elev, continent="NA", iso_country="US",
                 iso_region=region, municipality=muni, coordinates=coords)
        return tuple(d.get(c) for c in cols)

    airports = spark.createDataFrame([
        ap("KJFK", "large_airport", "John F Kennedy International Airport", "New York", "US-NY", "0, 0", None),
        ap("KLGA", "large_airport", "La Guardia Airport", "New York", "US-NY", "-73.87, 40.77"),
        ap("KIAH", "large_airport", "George Bush Intercontinental", "Houston", "US-TX", "-95.34, 29.98"),
        ap("KMDW", "large_airport", "Chicago Midway International", "Chicago", "US-IL", "-87.75, 41.78"),
        ap("KSML", "small_airport", "Tiny International", "Houston", "US-TX", "-95.0, 29.0"),
    ], schemas.AIRPORT_CODES)
    ports = spark.createDataFrame([("NYC", "NEW YORK", "NY", "NEW YORK"), ("HOU", "HOUSTON", "TX", "TEXAS"),
                                   ("CHI", "CHICAGO", "IL", "ILLINOIS")], schemas.PORT_DIM)
    got = {r.ident: r for r in jobs.airport_port_join(airports, ports).collect()}
    assert sorted(got) == ["KIAH", "KJFK"]
    assert (got["KJFK"].longitude, got["KJFK"].latitude, got["KJFK"].elevation_ft) == (-73.778889, 40.639722, 13.12)
    assert jobs.port_dimension_v2(jobs.airport_port_join(airports, ports)).count() == 2


def test_top_profiles_bounded(spark):
    df = spark.createDataFrame([(k % 5, k % 3) for k in range(100)], "a int, b int")
    got = jobs.top_profiles(df, ["a", "b"], 2).collect()
    assert sorted((r.dimension, r["rank"]) for r in got) == [("a", 1), ("a", 2), ("b", 1), ("b", 2)]
    assert F is not None


def test_complete_series_keeps_only_full_years(spark):
    # port 1: all 12 months; port 2: month 7 missing; port 3: 12 months but one twice
    rows = [(1, 2016, m, 10.0 + m, 5) for m in range(1, 13)]
    rows += [(2, 2016, m, 3.0, 1) for m in range(1, 13) if m != 7]
    rows += [(3, 2016, m, 1.0, 2) for m in range(1, 13)] + [(3, 2016, 4, 2.0, 9)]
    df = spark.createDataFrame(rows, "i94port_city_code int, entry_year int, entry_month int, "
                                     "average_temperature double, count int")
    got = jobs.complete_series(df, ["i94port_city_code", "entry_year"])
    assert got.columns == df.columns
    kept = {r.i94port_city_code: r.n for r in got.groupBy("i94port_city_code").agg(F.count("*").alias("n")).collect()}
    assert kept == {1: 12, 3: 13}
    # the brute-force rule: a key is complete when its distinct months are exactly 1..12
    brute = (df.groupBy("i94port_city_code", "entry_year").agg(F.count_distinct("entry_month").alias("m"))
               .where("m = 12").select("i94port_city_code").collect())
    assert sorted(r[0] for r in brute) == sorted(kept)
