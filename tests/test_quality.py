"""Checks and reporting metrics on small frames."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.operators.quality import (
    active_users,
    field_report,
    growth,
    key_violations,
    missing_days,
    outside_limits,
    profit_by,
    reconcile_counts,
    schema_drift,
    spikes,
)
from daymark.sources.schemas import QUALITY_CLASSES


def day(n):
    return dt.date(2024, 1, n)


def test_profit(spark):
    df = spark.createDataFrame(
        [("a", 0.1, 0.05), ("a", 0.2, 0.05), ("b", 0.0, 1.0)], "p string, r double, c double"
    )
    rows = {r.p: r for r in profit_by(df, ["p"], F.col("r"), F.col("c")).collect()}
    assert (rows["a"].revenue, rows["a"].cost, rows["a"].profit) == (0.3, 0.1, 0.2)
    assert rows["b"].margin is None
    alerts = outside_limits(profit_by(df, ["p"], F.col("r"), F.col("c")), "margin", low=0.5)
    assert [r.p for r in alerts.collect()] == ["b"]


def test_limits(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "m double")
    assert [r.m for r in outside_limits(df, "m", 1.5, 2.5).collect()] == [1.0, 3.0, None]


def test_missing_days(spark):
    df = spark.createDataFrame([("a", day(1)), ("a", day(3)), ("b", day(2))], "k string, d date")
    by_key = missing_days(df, ["k"], F.col("d"), day(1), day(3)).collect()
    assert sorted((r.k, r.missing_day.day) for r in by_key) == [("a", 2), ("b", 1), ("b", 3)]
    overall = missing_days(df.where("k = 'a'"), [], F.col("d"), day(1), day(4)).collect()
    assert sorted(r.missing_day.day for r in overall) == [2, 4]


def test_reconciliation(spark):
    left = spark.createDataFrame([("x",), ("x",), ("y",)], "k string")
    right = spark.createDataFrame([("x",), ("x",), ("z",)], "k string")
    rows = reconcile_counts(left, right, ["k"]).collect()
    assert {r.k: (r.left_count, r.right_count, r.difference, r.matches) for r in rows} == {
        "x": (2, 2, 0, True),
        "y": (1, 0, 1, False),
        "z": (0, 1, -1, False),
    }


def test_growth_with_a_return_and_an_empty_period(spark):
    rows = [("a", 1), ("a", 1), ("b", 1), ("a", 2), ("b", 5), ("c", 5)]
    df = spark.createDataFrame([(u, day(n)) for u, n in rows], "u string, d date")
    result = growth(df, "u", F.col("d"), F.date_add("day", 1), "day").collect()
    assert {
        r.day.day: (r.new_users, r.active_users, r.churned_users, r.net_new_users) for r in result
    } == {1: (2, 2, 0, 2), 2: (0, 1, 1, -1), 3: (0, 0, 1, -1), 5: (1, 2, 0, 1)}


def test_active_users(spark):
    df = spark.createDataFrame([(1, day(1)), (1, day(1)), (2, day(1)), (None, day(2))], "u int, d date")
    rows = active_users(df, "u", F.col("d"), "dau", "d").collect()
    assert {r.d.day: r.dau for r in rows} == {1: 2, 2: 0}


def test_spikes(spark):
    df = spark.createDataFrame(
        [("k", day(1), 100), ("k", day(2), 130), ("k", day(3), 90), ("k", day(5), 900), ("k", day(6), 0), ("k", day(7), 5)],
        "k string, d date, hits int",
    )
    rows = spikes(df, ["k"], "d", "hits", 0.3).collect()
    assert sorted((r.d.day, r.previous_hits) for r in rows) == [(3, 130), (6, 900)]


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c")], "i int, t string")
    rows = key_violations(df, ["i", "t"]).collect()
    assert {(r.i, r.t): r.row_count for r in rows} == {(1, "a"): 2, (None, "c"): 1}


def test_fields(spark):
    df = spark.createDataFrame([("star",), ("bad",), ("odd",), (None,)], "quality_class string")
    report = field_report(
        df,
        {
            "present": F.col("quality_class").isNotNull(),
            "allowed": F.col("quality_class").isin(*QUALITY_CLASSES),
        },
    )
    assert {r.rule: (r.failures, r.rows_checked) for r in report.collect()} == {
        "present": (1, 4),
        "allowed": (2, 4),
    }


def test_schema_drift():
    text, day_type = T.StringType(), T.DateType()
    old = T.StructType().add("a", T.IntegerType()).add("b", text).add("c", day_type)
    new = T.StructType().add("a", T.LongType()).add("b", text).add("d", day_type)
    assert schema_drift(old, new) == [
        ("a", "type changed", "int", "bigint"),
        ("c", "removed", "date", ""),
        ("d", "added", "", "date"),
    ]
    assert schema_drift(old, old) == []
