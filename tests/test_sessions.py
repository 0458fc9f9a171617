"""Batch sessions and their averages."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daymark.operators.sessions import average_events, average_events_by_host, sessionize

GAP = dt.timedelta(minutes=5)
T0 = dt.datetime(2024, 1, 1, 12)
SCHEMA = "ip string, host string, ts timestamp_ntz"


def events(spark, *seconds):
    rows = [("i", "h", None if s is None else T0 + dt.timedelta(seconds=s)) for s in seconds]
    return spark.createDataFrame(rows, SCHEMA)


def lengths(df):
    rows = sessionize(df, "ts", ["ip", "host"], GAP).orderBy("session_start").collect()
    return [r.events_in_session for r in rows]


def test_gap_border(spark):
    assert lengths(events(spark, 0, 300)) == [2]
    assert lengths(events(spark, 0, 301)) == [1, 1]
    assert lengths(events(spark, 0, 300.000001)) == [1, 1]


def test_time_is_required_and_ends_are_exact(spark):
    rows = sessionize(events(spark, 0, 10, None), "ts", ["ip", "host"], GAP).collect()
    assert [(r.session_start, r.session_end, r.events_in_session) for r in rows] == [
        (T0, T0 + dt.timedelta(seconds=310), 2)
    ]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
@pytest.mark.parametrize("gap", [dt.timedelta(seconds=7), GAP, dt.timedelta(hours=2)])
def test_sessions_equal_session_window(spark, kind, gap):
    rng = random.Random(4)
    rows = [
        (
            rng.choice(["i", "j", None]),
            rng.choice(["g", "h"]),
            T0 + dt.timedelta(microseconds=int(10**9 * 20 * rng.random() ** 2)),
        )
        for _ in range(500)
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.col("ts").cast(kind))
    window = F.session_window("ts", f"{int(gap.total_seconds())} seconds").alias("w")
    expected = (
        df.groupBy(window, "ip", "host")
        .agg(F.count(F.lit(1)).alias("events_in_session"))
        .select(
            "ip",
            "host",
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "events_in_session",
        )
    )
    assertDataFrameEqual(sessionize(df, "ts", ["ip", "host"], gap), expected, ignoreNullable=True)


def test_averages(spark):
    sessions = spark.createDataFrame(
        [("a.site", 1), ("a.site", 2), ("b.site", 4), ("other", 9)],
        "host string, events_in_session bigint",
    )
    row = average_events(sessions, F.col("host").like("%site%"), "avg_site").first()
    assert (row.metric, row.avg_events_per_session) == ("avg_site", 7 / 3)
    rows = average_events_by_host(sessions, ["a.site", "other", "absent"]).collect()
    assert {r.host: r.avg_events_per_session for r in rows} == {"a.site": 1.5, "other": 9.0}
    none = average_events(sessions, F.col("host") == "absent", "m").first()
    assert none.avg_events_per_session is None
