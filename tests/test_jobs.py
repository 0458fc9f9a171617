"""Jobs over stored tables: repeated runs, backfill of missing days, yearly history."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daymark.operators.activity import daily_metrics, date_list_snapshots, date_lists, reduce_month_full
from daymark.operators.history import scd2_backfill
from daymark.plans import jobs
from daymark.session import shared
from daymark.sources.readers import read_parquet, read_snapshot
from daymark.sources.writers import write_snapshot
from daymark.streaming import sinks

FIRST = dt.date(2024, 1, 29)
METRICS = {"hit_array": "hits", "unique_visitors_array": "unique_visitors"}


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(5)
    start = dt.datetime.combine(FIRST, dt.time())
    rows = [
        (rng.choice("abcd"), rng.randrange(5), start + dt.timedelta(hours=rng.randrange(96)))
        for _ in range(40)
    ]
    return spark.createDataFrame(rows, "host string, user int, ts timestamp_ntz").cache()


def day(n):
    return FIRST + dt.timedelta(days=n)


def test_missing_days_are_backfilled(spark, events, tmp_path):
    path, names = str(tmp_path / "hosts"), (["host"], "ts")
    jobs.start_activity_table(events, path, *names, day(0), "dates", "as_of")
    jobs.run_activity_day(
        read_parquet(spark, path), events, path, *names, day(1), "dates", "as_of"
    )
    # Day 3 is written without day 2, so it lacks the days before it.
    jobs.run_activity_day(
        read_parquet(spark, path), events, path, *names, day(3), "dates", "as_of"
    )
    written = jobs.backfill_activity(
        spark, events, path, *names, "dates", "as_of", day(0), day(3)
    )
    assert written == [day(2), day(3)]
    for n in range(4):
        stored = read_snapshot(spark, path, "as_of", day(n))
        expected = date_lists(events, ["host"], "ts", day(n), "dates", "as_of")
        assertDataFrameEqual(stored, expected, ignoreNullable=True)
    again = jobs.backfill_activity(spark, events, path, *names, "dates", "as_of", day(0), day(3))
    assert again == []


def test_month_arrays_over_a_month_border(spark, events, tmp_path):
    path = str(tmp_path / "months")
    empty = reduce_month_full(
        daily_metrics(events, ["host"], "ts", "user", day(0)), ["host"], day(0), METRICS
    )
    write_snapshot(empty, path, "month_start")
    for n in (1, 2, 3, 3):
        jobs.run_month_day(spark, events, path, ["host"], "ts", "user", day(n), METRICS)
    stored = read_parquet(spark, path)
    expected = reduce_month_full(
        daily_metrics(events, ["host"], "ts", "user"), ["host"], day(3), METRICS
    )
    assertDataFrameEqual(stored.select(expected.columns), expected, ignoreNullable=True)


def test_history_year_by_year(spark, tmp_path):
    rng, path = random.Random(6), str(tmp_path / "history")
    rows = [(n, y, rng.choice("xy")) for n in range(9) for y in range(2000 + n % 3, 2004)]
    yearly = spark.createDataFrame(rows, "id int, year int, class string")
    write_snapshot(scd2_backfill(yearly, ["id"], "year", ["class"], 2001), path, "year")
    for year in (2002, 2003, 2003):
        jobs.run_history_year(spark, yearly, path, ["id"], ["class"], "year", year)
    stored = read_snapshot(spark, path, "year", 2003)
    expected = scd2_backfill(yearly, ["id"], "year", ["class"], 2003)
    assertDataFrameEqual(stored.select(expected.columns), expected, ignoreNullable=True)


def test_shared_results_are_released(spark):
    df = spark.range(10).select((F.col("id") * 2).alias("n"))
    with shared(df) as kept:
        assert kept.storageLevel.useDisk and kept.count() == 10
    assert not kept.storageLevel.useMemory


def test_jdbc_outputs(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(
        sinks, "jdbc_write", lambda df, options, mode: calls.append((df.columns, options, mode))
    )
    output = sinks.jdbc_output({"sessions": {"dbtable": "s"}, "host_averages": {"dbtable": "h"}})
    for name in ("sessions", "averages", "host_averages"):
        output(name, spark.range(1), 7)
    assert calls == [
        (["id", "batch"], {"dbtable": "s"}, "append"),
        (["id"], {"dbtable": "h"}, "overwrite"),
    ]


@pytest.mark.parametrize("first, last", [(0, 0), (1, 3), (0, 6), (3, 3), (2, 40)])
def test_many_days_at_once_equal_day_after_day(spark, events, tmp_path, first, last):
    """Snapshots and month arrays, over a month border, with a NULL key and days without events."""
    rows = events.unionByName(events.limit(5).withColumn("host", F.lit(None).cast("string")))
    names, paths = (["host"], "ts"), [str(tmp_path / n) for n in ("step", "once")]
    for path in paths:
        jobs.run_month_day(spark, rows, path, *names, "user", day(-1), METRICS)
        for n in range(first):
            jobs.run_month_day(spark, rows.where("host IS NOT NULL"), path, *names, "user", day(n), METRICS)
    known = rows.where("host IS NOT NULL")
    for n in range(first, last + 1):
        jobs.run_month_day(spark, known, paths[0], *names, "user", day(n), METRICS)
    for _ in range(2):
        jobs.backfill_months(spark, known, paths[1], *names, "user", day(first), day(last), METRICS)
    assertDataFrameEqual(*[read_parquet(spark, p).select("month_start", "host", *METRICS) for p in paths])


def test_months_of_an_empty_path(spark, events, tmp_path):
    path = str(tmp_path / "months")
    jobs.backfill_months(spark, events, path, ["host"], "ts", "user", day(0), day(3), METRICS)
    expected = reduce_month_full(daily_metrics(events, ["host"], "ts", "user"), ["host"], day(3), METRICS)
    assertDataFrameEqual(read_parquet(spark, path).select(expected.columns), expected)


def test_snapshots_of_many_days_keep_null_keys_together(spark, events):
    rows = events.unionByName(events.limit(9).withColumn("host", F.lit(None).cast("string")))
    before = date_lists(rows, ["host"], "ts", day(0), "dates", "as_of")
    got = date_list_snapshots(before, rows, ["host"], "ts", day(1), day(5), "dates", "as_of")
    for n in range(1, 6):
        expected = date_lists(rows, ["host"], "ts", day(n), "dates", "as_of")
        assertDataFrameEqual(got.where(F.col("as_of") == F.lit(day(n))), expected, ignoreNullable=True)
