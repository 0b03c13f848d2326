"""One named test per fault mended: wrong rows, plans that read too often, jobs launched while planning."""

import datetime as dt
import math
import os
import re
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from entryclime.functions import dates, geo, text
from entryclime.operators import joins, quality
from entryclime.plans import catalog as C
from entryclime.plans import fixtures as fx
from entryclime.plans import jobs
from entryclime.sources import readers, writers

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def reads(df, table):
    """Scans of a table in the physical plan, a shared exchange counted once."""
    return len(re.findall(rf"FileScan parquet .*{table}\.parquet", df._jdf.queryExecution().executedPlan().toString()))


# ------------------------------------------------------------------ wrong rows
def test_date_window_does_not_depend_on_the_machine_zone():
    code = ("import sys; sys.path.insert(0, '.')\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false')"
            ".config('spark.sql.session.timeZone', 'UTC').getOrCreate()\n"
            "from entryclime.plans import fixtures as fx\n"
            "df = fx.table(s, '/root/testdata/sf0.01', 'lineitem').where(fx.ship_filter(*fx.CLIMATE_WINDOW))\n"
            "print('ROWS', df.count(), 'PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual' in "
            "df._jdf.queryExecution().executedPlan().toString())\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, env=os.environ | {"TZ": "America/New_York"},
                         capture_output=True, text=True, timeout=300).stdout
    assert "ROWS 35085 True" in out


def test_sas_days_outside_the_calendar_are_null(spark):
    rows = [(20573.0,), (20573.9,), (0.0,), (None,), (float("nan"),), (1e12,), (-1e12,), (float("inf"),), (-1.0,)]
    got = [r[0] for r in spark.createDataFrame(rows, "d double").select(dates.sas_to_date("d")).collect()]
    assert got == [dt.date(2016, 4, 29)] * 2 + [None] * 6 + [dt.date(1959, 12, 31)]


def test_tabs_and_line_ends_are_white_space(spark):
    df = spark.createDataFrame([("'ALCAN, AK\t'",), ("\t NEW  YORK,\tNY \n",)], "v string")
    got = df.select(text.remove_quotes("v"), text.last_token(text.remove_quotes("v")),
                    text.all_but_last_token(text.remove_quotes("v")), text.split_city_state("v")["state"]).collect()
    assert tuple(got[0])[:3] == ("ALCAN, AK", "AK", "ALCAN,")
    assert tuple(got[1])[1:] == ("NY", "NEW YORK,", "NY")
    book = spark.createDataFrame([("'ALC'", "'ALCAN, AK\t'")], "code string, value string")
    states = spark.createDataFrame([("'AK'", "'ALASKA'")], "state_code string, state_name string")
    assert [tuple(r) for r in jobs.port_dimension(book, states).collect()] == [("ALC", "ALCAN", "AK", "ALASKA")]


def test_retention_of_nothing(spark):
    raw = C.fact_raw(spark, SF).limit(0)
    for r in (jobs.retention(raw, raw).first(), jobs.entry_retention(raw).first()):
        assert (r.n_in, r.n_out, r.retention) == (0, 0, None)


def test_retention_in_one_read_equals_the_two_counts(spark):
    raw = C.fact_raw(spark, SF)
    raw = raw.unionAll(raw.limit(50)).unionAll(raw.limit(20).withColumn("cicid", F.lit(None).cast("double")))
    assert jobs.entry_retention(raw).first() == jobs.retention(raw, jobs.entry_fact(raw)).first()


def test_a_rewritten_table_is_read_anew(spark, tmp_path):
    path = str(tmp_path / "nation.parquet")
    spark.range(3).write.parquet(path)
    assert fx.table(spark, str(tmp_path), "nation").columns == ["id"]
    spark.range(3).select(F.col("id").alias("other")).write.mode("overwrite").parquet(path)
    assert [r.other for r in fx.table(spark, str(tmp_path), "nation").orderBy("other").collect()] == [0, 1, 2]



def _vincenty(lat1, lon1, lat2, lon2):
    """Iterative solution on the ellipsoid, written apart from the library's closed form."""
    a, f = 6378.137, 1 / 298.257223563
    b = a * (1 - f)
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(x))) for x in (lat1, lat2))
    lam = diff = math.radians((lon2 - lon1 + 540) % 360 - 180)
    for _ in range(200):
        sin_s = math.hypot(math.cos(u2) * math.sin(lam),
                           math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if not sin_s:
            return 0.0
        cos_s = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        s = math.atan2(sin_s, cos_s)
        sin_a = math.cos(u1) * math.cos(u2) * math.sin(lam) / sin_s
        cos2 = 1 - sin_a ** 2
        cos_m = cos_s - 2 * math.sin(u1) * math.sin(u2) / cos2 if cos2 else 0
        c = f / 16 * cos2 * (4 + f * (4 - 3 * cos2))
        new = diff + (1 - c) * f * sin_a * (s + c * sin_s * (cos_m + c * cos_s * (2 * cos_m ** 2 - 1)))
        if abs(new - lam) < 1e-13:
            break
        lam = new
    k = cos2 * (a * a - b * b) / (b * b)
    big_a = 1 + k / 16384 * (4096 + k * (-768 + k * (320 - 175 * k)))
    big_b = k / 1024 * (256 + k * (-128 + k * (74 - 47 * k)))
    d = big_b * sin_s * (cos_m + big_b / 4 * (cos_s * (2 * cos_m ** 2 - 1)
                                              - big_b / 6 * cos_m * (4 * sin_s ** 2 - 3) * (4 * cos_m ** 2 - 3)))
    return b * big_a * (s - d)


@pytest.mark.parametrize("points", [
    (40.0, -75.0, 40.009, -75.0), (40.0, -75.0, 41.6165, -75.0), (40.0, -75.0, 41.6255, -75.0),
    (33.9, -118.4, 33.9, -116.46), (89.2, 10.0, 89.5, 170.0), (51.9, 179.4, 52.1, -178.9), (0.0, 0.0, 0.0, 1.5)])
def test_lambert_distance_to_a_metre(spark, points):
    got = spark.createDataFrame([points], "a double, b double, c double, d double").select(
        geo.lambert_km("a", "b", "c", "d")).first()[0]
    assert abs(got - _vincenty(*points)) < 0.001


def test_threshold_cases_lie_on_both_sides():
    assert _vincenty(40.0, -75.0, 41.6165, -75.0) < 180 < _vincenty(40.0, -75.0, 41.6255, -75.0)


# ------------------------------------------------------------------ plans
def test_the_fact_composes_lazily(spark):
    ports = spark.createDataFrame([("P01", "a", "b")], "i94port_code string, city string, state_code string")
    temp = spark.createDataFrame([("a", "b", 1, 2.0)], "city string, state_id string, month int, average_temperature double")
    chain = jobs.analytical_table(jobs.entry_fact(C.fact_raw(spark, SF)), ports, temp)
    t = time.time()
    plan(chain)
    assert time.time() - t < 5


@pytest.mark.parametrize("name,table,most", [
    ("entity_profiles", "orders", 1), ("top_n_share", "orders", 2), ("retention_audit", "orders", 1),
    ("value_profile", "events", 1), ("drop_null_rows", "lineitem", 1), ("unmatched_codes", "lineitem", 1),
    ("airport_concentration", "orders", 1), ("city_temperature_dim", "lineitem", 1)])
def test_tables_are_read_once(spark, name, table, most):
    assert 1 <= reads(C.QUERIES[name](spark, SF), table) <= most


def test_climate_window_reaches_the_scan(spark):
    shown = C.city_temperature_dim(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_shipdate" in shown


WRITERS = {"csv_roundtrip", "delimited_scan", "partitioned_roundtrip", "multi_file_month_scan", "incremental_month_load",
           "drifting_month_scan", "json_stage_load", "insert_fact", "insert_dimension", "gate_counts", "quality_counts",
           "full_pipeline", "fact_clean", "published_release", "ordered_month_export", "sliced_load", "observed_fact_load",
           "file_row_counts", "quarantined_scan", "distinct_sketch"}


def test_building_a_query_launches_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name in sorted(set(C.QUERIES) - WRITERS):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        C.QUERIES[name](spark, SF)
        launched = [j for j in tracker.getJobIdsForGroup(f"build-{name}")]
        # reading a parquet footer's schema is a one-task job per table; nothing else may run
        for j in launched:
            stages = tracker.getJobInfo(j).stageIds
            assert len(stages) == 1 and tracker.getStageInfo(stages[0]).numTasks == 1, name
    spark.sparkContext.setJobGroup("tests", "tests")


def test_the_gate_counts_once(spark):
    counted = spark.sparkContext.accumulator(0)

    def count(rows):
        for r in rows:
            counted.add(1)
            yield r

    df = spark.createDataFrame(spark.range(10, numPartitions=2).rdd.mapPartitions(count), "id long")
    quality.assert_quality(quality.row_counts({"t": df})).collect()
    assert counted.value == 10


# ------------------------------------------------------------------ files and tables
def test_read_months_with_drift_and_gaps(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([(1.0, "a")], "cicid double, i94port string").write.parquet(f"{root}/i94_apr16_sub.parquet")
    spark.createDataFrame([(9.0, 2.0, "b")], "validres double, cicid double, i94port string").write.parquet(
        f"{root}/i94_jun16_sub.parquet")
    schema = spark.createDataFrame([], "cicid double, i94port string").schema
    got = readers.read_months(spark, root, "2016-04-01", "2016-06-30", schema, skip_missing=True)
    got = readers.with_file_token(got, r"i94_([a-z]{3}\d{2})_sub", "token")
    assert sorted(tuple(r) for r in got.collect()) == [(1.0, "a", "apr16"), (2.0, "b", "jun16")]
    with pytest.raises(Exception, match="(?i)path"):
        readers.read_months(spark, root, "2016-04-01", "2016-06-30", schema).collect()


def test_monthly_files_are_sorted_and_named(spark, tmp_path):
    df = spark.createDataFrame([("2016-04", "b", 2), ("2016-04", "a", 5), ("2016-05", "c", 1), ("2016-04", "c", 5)],
                               "month string, port string, count long").repartition(3)
    path = writers.write_monthly_csv(df, str(tmp_path / "out"), "month", [F.desc("count"), F.asc("port")])
    assert sorted(p.name for p in (tmp_path / "out").glob("*.csv")) == ["2016-04.csv", "2016-05.csv"]
    assert (tmp_path / "out/2016-04.csv").read_text().splitlines() == ["index,port,count", "0,a,5", "1,c,5", "2,b,2"]
    assert path == str(tmp_path / "out")


def test_anti_join_folds_a_hot_reference(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    hot = spark.range(1000).select(F.lit(1).cast("long").alias("r"))
    assert [r.k for r in joins.unmatched(left, hot, "k", "r").orderBy("k").collect()] == [None, 2]


def test_airport_fan_out(spark):
    fact = spark.createDataFrame([("P1", "NY")] * 3 + [("P2", "CA")] + [("P3", "TX")],
                                 "i94port_city_code string, destination_state_code string")
    airports = spark.createDataFrame([("P1",), ("P1",), ("P2",)], "i94port_code string")
    got = {(r["dimension"], r["value"]): (r["count"], r["rank"], round(r["top_share"], 4))
           for r in jobs.airport_concentration(fact, airports, n=1).collect()}
    assert got == {("port", "P1"): (6, 1, 0.8571), ("state", "NY"): (6, 1, 0.8571)}
