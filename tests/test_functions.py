"""Scalar functions on the edge rows listed in FIXTURES.md §3."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from entryclime.functions import dates, geo, text


def one_col(spark, values, name="x", ddl="string"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {ddl}")


def apply(spark, values, fn, ddl="string"):
    df = one_col(spark, values, ddl=ddl)
    return [r[0] for r in df.select(fn(F.col("x"))).collect()]


def test_quotes_and_tokens(spark):
    assert apply(spark, ["'ALCAN, AK'", None], text.remove_quotes) == ["ALCAN, AK", None]
    assert apply(spark, ["ALCAN, AK  ", "SAN  JUAN PR", "ONE"], text.last_token) == ["AK", "PR", "ONE"]
    assert apply(spark, ["ALCAN, AK  ", "SAN  JUAN PR", "ONE"], text.all_but_last_token) == ["ALCAN,", "SAN JUAN", ""]


def test_state_after_first_comma(spark):
    vals = ["DERBY, VT", "A, B, NY", "NO COMMA", "X, ABC", None]
    assert apply(spark, vals, text.state_after_comma) == ["VT", None, None, None, None]
    assert apply(spark, vals, text.city_before_comma) == ["DERBY", "A", "NO COMMA", "X", None]


def test_suffix_and_dash(spark):
    assert apply(spark, ["NOGALES,", "NOGALES", "A,,"], text.strip_trailing_comma) == ["NOGALES", "NOGALES", "A,"]
    assert apply(spark, ["A,", "A ", "A"], text.strip_trailing_comma_or_space) == ["A", "A", "A"]
    assert apply(spark, ["X - Y", "PLAIN", "A - B - C"], text.text_after_dash) == ["Y", "PLAIN", "B"]
    assert apply(spark, ["US-NY"], lambda c: text.right_chars(c, 2)) == ["NY"]
    assert apply(spark, [" 'Air'"], text.inner_slice) == ["Air"]
    assert apply(spark, ["1 = 'Air'"], text.first_char) == ["1"]
    assert apply(spark, [" Student"], text.drop_first_char) == ["Student"]


def test_clean_column_names():
    assert text.clean_column_names(["Median Age", "Foreign-born", "city"]) == ["median_age", "foreign_born", "city"]


def test_sas_days(spark):
    got = apply(spark, [None, 0.0, 20573.0, 20573.7, -1.5], dates.sas_to_date, ddl="double")
    assert got == [None, None, dt.date(2016, 4, 29), dt.date(2016, 4, 29), dt.date(1959, 12, 30)]


def test_stay_pattern_and_normaliser(spark):
    vals = ["10222016", "10222020", "d/s", "D/S", "10222016zz", "x10222016", "19392026", "", None]
    assert apply(spark, vals, dates.stay_pattern_ok) == [True, False, True, True, True, False, True, False, False]
    assert apply(spark, vals, dates.stay_date) == ["2016-10-22", "2020-10-22", None, "D/S", None, None, None, None, None]


def test_compact_date(spark):
    assert apply(spark, ["20160422", None, "2016042x", "20161322"], dates.compact_to_date) == [
        dt.date(2016, 4, 22), None, None, None]


def test_month_tokens(spark):
    df = spark.createDataFrame([(dt.date(2016, 4, 1),)], "d date")
    r = df.select(dates.month_token("d").alias("t"), dates.year_month("d").alias("ym")).first()
    assert (r.t, r.ym) == ("apr16", "2016-04")


def test_half_open_window(spark):
    vals = [dt.date(2003, 8, 1), dt.date(2003, 9, 1), dt.date(2013, 8, 1), dt.date(2013, 9, 1)]
    df = spark.createDataFrame([(v,) for v in vals], "x date")
    got = [r[0] for r in df.select(dates.half_open("x", "2003-09-01", "2013-09-01")).collect()]
    assert got == [False, True, True, False]


def test_coordinates(spark):
    df = one_col(spark, ["-73.9, 40.6", "0, 0", "-73.9 40.6", None])
    got = [(r.c.longitude, r.c.latitude) for r in df.select(geo.split_coordinates("x").alias("c")).collect()]
    assert got == [(-73.9, 40.6), (0.0, 0.0), (None, None), (None, None)]


def test_hemispheres(spark):
    vals = ["32.01N", "32.01S", "32.01n", "32.01"]
    assert apply(spark, vals, geo.latitude_degrees) == [32.01, -32.01, None, None]
    assert apply(spark, ["100.01E", "100.01W"], geo.longitude_degrees) == [100.01, -100.01]
    lenient = apply(spark, vals, lambda c: geo.hemisphere_degrees_lenient(c, "N", "S"))
    assert lenient == [32.01, -32.01, 32.01, 32.01]


def test_zero_and_fill(spark):
    assert apply(spark, [0.0, 5.0], lambda c: geo.replace_zero(c, geo.JFK_LONGITUDE), ddl="double") == [
        geo.JFK_LONGITUDE, 5.0]


def test_distances(spark):
    df = spark.createDataFrame([(40.6397, -73.7789, 33.9425, -118.4081), (10.0, 20.0, 10.0, 20.0)],
                               "a double, b double, c double, d double")
    got = [tuple(r) for r in df.select(geo.lambert_km("a", "b", "c", "d"), geo.haversine_km("a", "b", "c", "d")).collect()]
    # JFK -> LAX: ellipsoidal geodesic about 3983 km; the sphere gives about 3975 km
    assert got[0][0] == pytest.approx(3983.0, abs=2.0)
    assert got[0][1] == pytest.approx(3975.0, abs=3.0)
    assert got[1] == (0.0, 0.0)
