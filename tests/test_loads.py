"""Releases, slices, the narrow dedup, ordered exports and counts: what they promise beyond their queries' results."""

import datetime as dt
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from entryclime.operators import aggregates as agg
from entryclime.operators import dedup, keyfilter, quality
from entryclime.plans import catalog, jobs
from entryclime.session import scratch_path, shared_dir
from entryclime.sources import readers, releases, slices, writers
from tests.conftest import rows

SF_DIR = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ write, audit, publish
def numbers(spark, n):
    return spark.range(n).withColumn("half", F.col("id") % 2)


def publish(spark, root, n, **options):
    run = releases.Staging(spark, root)
    run.write("t", numbers(spark, n))
    return run.publish(**options)


def test_a_failed_audit_leaves_the_old_tables(spark):
    root = scratch_path(spark, "release_test")
    with pytest.raises(LookupError):
        releases.read_current(spark, root, "t")
    assert publish(spark, root, 10).number == 1
    held = releases.current(spark, root)
    with pytest.raises(quality.QualityCheckError, match="half"):
        publish(spark, root, 20, audit=lambda t: quality.unique_key(t["t"], "half twice", ["half"]))
    with pytest.raises(quality.QualityCheckError, match=r"t \(4 rows, 10 before\)"):
        publish(spark, root, 4, least_share=0.5)
    with pytest.raises(quality.QualityCheckError):
        publish(spark, root, 0)
    assert releases.current(spark, root) == held and held.read(spark, "t").count() == 10
    assert publish(spark, root, 20).rows == {"t": 20}
    assert releases.read_current(spark, root, "t").count() == 20
    assert held.read(spark, "t").count() == 10  # a reader of the old release keeps its tables


def test_of_two_runs_only_one_publishes(spark):
    root = scratch_path(spark, "release_test")
    publish(spark, root, 3)
    one, two = releases.Staging(spark, root), releases.Staging(spark, root)
    for run, n in ((one, 5), (two, 6)):
        run.write("t", numbers(spark, n))
    two.publish()
    with pytest.raises(releases.PublishConflict):
        one.publish()
    assert releases.read_current(spark, root, "t").count() == 6


def test_an_incomplete_entry_is_not_read(spark):
    root = scratch_path(spark, "release_test")
    publish(spark, root, 3)
    releases._create(spark, f"{root}/log/{2:010d}", "no end of line")  # a publisher died here
    assert releases.current(spark, root).number == 1
    assert publish(spark, root, 4).number == 3
    assert [r.number for r in releases.history(spark, root)] == [1, 3]


def test_prune_keeps_what_releases_use(spark):
    root = scratch_path(spark, "release_test")
    for n in (3, 4):
        publish(spark, root, n)
    run = releases.Staging(spark, root)
    run.carry("t")
    run.write("u", numbers(spark, 2))
    assert run.publish().rows == {"t": 4, "u": 2}
    assert releases.prune(spark, root, keep=1) == []  # all younger than the grace period
    assert len(releases.prune(spark, root, keep=1, grace_seconds=-10)) == 1
    assert releases.read_current(spark, root, "t").count() == 4 and releases.read_current(spark, root, "u").count() == 2


# ------------------------------------------------------------------ slices
EVENTS = "id long, at timestamp_ntz, value string"


def events(spark, *items):
    return spark.createDataFrame([(i, dt.datetime.fromisoformat(t), v) for i, t, v in items], EVENTS)


def loaded(spark, root):
    return sorted(rows(slices.read(spark, root, EVENTS), "slice", "id", "value"))


@pytest.mark.parametrize("grain, names", [("month", {"2016-04"}), ("day", {"2016-04-01", "2016-04-02"}),
                                          ("hour", {"2016-04-01-00", "2016-04-01-23", "2016-04-02-00"})])
def test_runs_may_be_repeated(spark, grain, names):
    root = scratch_path(spark, "slices")
    df = events(spark, (1, "2016-04-01 00:00", "a"), (2, "2016-04-01 23:59", None), (3, "2016-04-02 00:00", "c"))
    assert {r["slice"] for r in slices.load(df, root, "at", grain).collect()} == names
    before = loaded(spark, root)
    assert slices.load(df.repartition(3), root, "at", grain).count() == 0
    assert loaded(spark, root) == before and len(before) == 3


def test_late_rows_replace_their_slice_only(spark):
    root = scratch_path(spark, "slices")
    first = events(spark, (1, "2016-04-01 10:00", "a"), (2, "2016-04-02 10:00", "b"), (3, "2016-04-03 10:00", "c"))
    slices.load(first, root, "at", "day")
    late = events(spark, (2, "2016-04-02 10:00", "b"), (4, "2016-04-02 11:00", "late"))
    assert [r["slice"] for r in slices.load(late, root, "at", "day").collect()] == ["2016-04-02"]
    assert loaded(spark, root) == [("2016-04-01", 1, "a"), ("2016-04-02", 2, "b"), ("2016-04-02", 4, "late"),
                                   ("2016-04-03", 3, "c")]
    # a whole range without rows for its second day: that day becomes empty
    slices.load(events(spark, (1, "2016-04-01 10:00", "a")), root, "at", "day", "2016-04-01", "2016-04-02")
    assert loaded(spark, root) == [("2016-04-01", 1, "a"), ("2016-04-03", 3, "c")]
    assert slices.vacuum(spark, root) == 2 and len(loaded(spark, root)) == 2


def test_a_run_without_ledger_entry_is_not_read(spark):
    root = scratch_path(spark, "slices")
    df = events(spark, (1, "2016-04-01 10:00", "a"))
    slices.load(df, root, "at", "day")
    died = df.withColumns({"slice": F.lit("2016-04-01"), "run": F.lit("died")})
    died.write.mode("append").partitionBy("slice", "run").parquet(f"{root}/rows")
    assert loaded(spark, root) == [("2016-04-01", 1, "a")]


def test_rows_outside_the_range_or_time_are_errors(spark):
    root = scratch_path(spark, "slices")
    with pytest.raises(Exception, match="outside the loaded slices"):
        slices.load(events(spark, (1, "2016-05-01 10:00", "a")), root, "at", "day", "2016-04-01", "2016-04-30")
    with pytest.raises(Exception, match="outside the loaded slices"):
        slices.load(spark.createDataFrame([(1, None, "a")], EVENTS), root, "at", "day")
    assert slices.load(spark.createDataFrame([], EVENTS), root, "at", "day").count() == 0
    assert slices.read(spark, root, EVENTS).count() == 0


# ------------------------------------------------------------------ narrow dedup
@pytest.mark.parametrize("words", [None, 1])
def test_narrow_dedup_is_the_same(spark, monkeypatch, words):
    if words:  # a filter that is full takes every row for a repeated one
        monkeypatch.setattr(keyfilter, "words_for", lambda keys: words)
    items = [(k, i, f"v{i % 3}") for i, k in enumerate([None, None, *range(200), *range(0, 200, 7), *[5] * 50])]
    df = spark.createDataFrame(items, "k long, o int, v string").repartition(4)
    want = sorted(rows(dedup.first_per_key(df, ["k"]), "k", "o", "v"), key=str)
    assert sorted(rows(dedup.first_per_key_narrow(df, ["k"]), "k", "o", "v"), key=str) == want
    alone, shared = dedup.split_repeated(df, ["k"])
    assert alone.count() + shared.count() == len(items) and alone.count() in (range(120) if words else range(160, 171))
    assert dedup.split_repeated(df.limit(0), ["k"])[1] is None


def test_the_filter_never_misses_and_stays_small(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("k"))
    words = keyfilter.words_for(20_000)
    filled = keyfilter.filter_words(keys, "k", words).cache()
    assert filled.count() <= words == 8192
    assert keyfilter.mark_members(keys, filled, "k", words, "in").where("in").count() == 20_000
    foreign = spark.range(100_000, 140_000).select(F.xxhash64("id").alias("k"))
    assert keyfilter.mark_members(foreign, filled, "k", words, "in").where("in").count() < 2_000
    assert keyfilter.words_for(10 ** 12) == keyfilter.MOST_WORDS and keyfilter.words_for(0) == keyfilter.LEAST_WORDS


def test_narrow_fact_is_the_fact(spark):
    raw = catalog.fact_raw(spark, SF_DIR)
    doubled = writers.write_parquet(raw.unionByName(raw.where("cicid % 5 = 0").withColumn("i94bir", F.lit(1.0)))
                                    .unionByName(raw.limit(3).withColumn("cicid", F.lit(None).cast("double"))),
                                    scratch_path(spark, "doubled"))
    stored = spark.read.parquet(doubled)
    narrow, wide = jobs.entry_fact_narrow(stored), jobs.entry_fact(stored)
    assert narrow.columns == wide.columns and narrow.schema == wide.schema
    assert narrow.exceptAll(wide).isEmpty() and wide.exceptAll(narrow).isEmpty() and not wide.isEmpty()


# ------------------------------------------------------------------ exports and counts
def test_one_month_is_numbered_over_many_tasks(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "2016-01").otherwise("2016-02").alias("m"),
                                  (F.col("id") * 7919 % 1000).alias("x"))
    path = writers.write_ordered_csv(df, scratch_path(spark, "ordered"), "m", [F.desc("x")], parts=6)
    back = spark.read.schema("index long, x long, m string, part string").option("header", True).csv(path)
    got = back.orderBy("m", "index").collect()
    for month in ("2016-01", "2016-02"):
        own = [r for r in got if r["m"] == month]
        assert [r["index"] for r in own] == list(range(len(own)))
        assert [r["x"] for r in own] == sorted((r["x"] for r in own), reverse=True)
        assert [r["part"] for r in own] == sorted(r["part"] for r in own)
    assert len({r["part"] for r in got if r["m"] == "2016-01"}) > 3


def test_counts_come_from_footers(spark):
    path = writers.write_parquet(numbers(spark, 1000), scratch_path(spark, "footers"), ["half"])
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    assert quality.file_row_counts(spark, {"a": path, "b": f"{SF_DIR}/orders.parquet"}) == {"a": 1000, "b": 1500}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "csv")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    plan = quality.counted_by_footers(own, f"{SF_DIR}/orders.parquet")._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan or "pushedAggregation=[COUNT(*)]" in plan.replace("PushedAggregation", "pushedAggregation")


def test_observed_counts_are_those_written(spark):
    path = scratch_path(spark, "observed")
    seen = writers.write_observed(numbers(spark, 100), path, {"n": F.count(F.lit(1)), "odd": F.sum("half")}, ["half"])
    assert seen == {"n": 100, "odd": 50} and spark.read.parquet(path).count() == 100


# ------------------------------------------------------------------ the optional part, shared folders
def test_a_missing_library_leaves_the_core_queries():
    code = ("import sys; sys.modules['xxhash'] = None; import __spark_entry__ as E; "
            "assert not E.HAS_LLM and 'fact_clean' in E.queries() and 'op3_exact_dedup' not in E.queries()")
    subprocess.run([sys.executable, "-c", code], check=True)


def test_a_cluster_needs_a_named_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return default

        def contains(self, key):
            return False

    class NoDir:
        def getCheckpointDir(self):
            return self

        def isDefined(self):
            return False

        def sc(self):
            return self

    class Context:
        master, _jsc = "spark://host:7077", NoDir()

        def getConf(self):
            return Conf()

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
    assert shared_dir(spark)


# ------------------------------------------------------------------ bad records, sketches
def test_bad_lines_are_kept_apart(spark):
    lines = ["1;a;2.5", "x;b;1", "3;c", "4;d;1;2", "5;;", "", "6;e;n/a"]
    path = writers.write_text(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1),
                              scratch_path(spark, "bad_lines"))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("t", T.StringType()),
                           T.StructField("x", T.DoubleType())])
    good, bad = readers.read_csv_checked(spark, path, schema, header=False, sep=";")
    assert sorted(rows(good, "k", "t", "x")) == [(1, "a", 2.5), (5, None, None)]
    assert sorted(rows(bad, "reason", "record")) == [("fields", "3;c"), ("fields", "4;d;1;2"), ("value", "6;e;n/a"),
                                                    ("value", "x;b;1")]
    assert all(r["file"].endswith(".txt") for r in bad.collect())


def test_merged_sketches_stay_within_their_error(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("m"), (F.col("id") % 20_000 + F.col("id") % 3 * 5_000).alias("v"))
    sketches = agg.distinct_sketches(df, ["m"], "v")
    estimate = agg.merged_distinct(sketches, []).first()["n_distinct"]
    exact = df.select("v").distinct().count()
    assert abs(estimate - exact) <= 0.05 * exact
    assert agg.merged_distinct(sketches.where("m < 0"), ["m"]).count() == 0
