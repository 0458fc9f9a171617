"""Experiment metrics on small frames."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from daymark.operators.experiments import (
    cell,
    compare_cells,
    compare_means,
    continued_share,
    conversion_rate,
    conversions,
    early_actions,
    funnel,
    funnel_counts,
    merge_moments,
    moments,
    weekly_retention,
)

T0 = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame(
        [(u, T0 + dt.timedelta(hours=h), kind) for u, h, kind in rows],
        "u int, ts timestamp_ntz, kind string",
    )


@pytest.mark.parametrize("max_rows", [5, 1000])
def test_conversions_equal_a_search(spark, max_rows):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(300), rng.choice("ssp")) for _ in range(150)]
    within = 12
    found = conversions(
        events(spark, rows), "u", "ts", F.col("kind") == "s", F.col("kind") == "p",
        dt.timedelta(hours=within), max_rows,
    )
    expected = []
    for u, h, kind in rows:
        if kind == "s":
            hits = [g for v, g, k in rows if v == u and k == "p" and h <= g <= h + within]
            expected.append((u, h, min(hits) if hits else -1))
    hours = lambda t: int((t - T0).total_seconds()) // 3600
    actual = [
        (r.u, hours(r.started_at), hours(r.converted_at) if r.converted else -1)
        for r in found.collect()
    ]
    assert sorted(actual) == sorted(expected)
    rate = conversion_rate(found).first()
    assert rate.starts == len(expected)
    assert rate.conversions == sum(e[2] >= 0 for e in expected)


def test_conversion_border_is_included(spark):
    df = events(spark, [(1, 0, "s"), (1, 72, "p"), (2, 0, "s"), (2, 73, "p"), (3, 5, "s")])
    rows = conversions(
        df, "u", "ts", F.col("kind") == "s", F.col("kind") == "p", dt.timedelta(hours=72)
    ).collect()
    assert {r.u: r.converted for r in rows} == {1: True, 2: False, 3: False}


def test_early_actions(spark):
    df = events(spark, [(1, 0, "view"), (1, 1, "like"), (1, 23, "like"), (1, 24, "like"), (2, 0, "view")])
    rows = early_actions(df, "u", "ts", F.col("kind") == "like", dt.timedelta(days=1)).collect()
    assert {r.u: r.actions for r in rows} == {1: 2, 2: 0}


def test_week_4_retention(spark):
    df = events(spark, [(1, 0, "v"), (1, 24 * 21, "v"), (2, 0, "v"), (2, 24 * 20, "v"), (3, 0, "v"), (3, 24 * 28, "v"), (4, 24, "v")])
    day = F.col("ts").cast("date")
    rows = weekly_retention(df, "u", day, 4, F.col("first_day")).collect()
    assert {r.cohort.day: (r.cohort_size, r.retained) for r in rows} == {1: (3, 1), 2: (1, 0)}


def test_continued_conversations(spark):
    df = spark.createDataFrame([(c,) for c in [1] * 3 + [2] * 4 + [3]], "c int")
    row = continued_share(df, "c", 3).first()
    assert (row.conversations, row.continued, row.continued_share) == (3, 1, 1 / 3)


def test_cells_are_even_fixed_and_independent(spark):
    df = spark.range(10_000).select(
        "id", cell("id", "one").alias("a"), cell("id", "two").alias("b"), cell("id", "one", 10).alias("c")
    )
    counts = {(r.a, r.b): r["count"] for r in df.groupBy("a", "b").count().collect()}
    assert len(counts) == 4 and all(2300 < n < 2700 for n in counts.values())
    assert 900 < df.where("c = 'treatment'").count() < 1100
    assert df.where("c = 'treatment' and a = 'control'").count() == 0


def test_comparison(spark):
    rows = [("control", n < 20) for n in range(100)] + [("treatment", n < 35) for n in range(100)]
    df = spark.createDataFrame(rows, "cell string, won boolean")
    row = compare_cells(df, "cell", F.col("won")).first()
    pooled = 55 / 200
    assert (row.control_rate, row.treatment_rate) == (0.2, 0.35)
    assert row.z == pytest.approx(0.15 / math.sqrt(pooled * (1 - pooled) * 2 / 100))
    empty = compare_cells(df.where("cell = 'control'"), "cell", F.col("won")).first()
    assert empty.treatment_rate is None and empty.z is None


def walk(rows, user, at, steps):
    """Times of a chain of steps, by looking at all events."""
    out = []
    for name, within in steps:
        found = min((t for u, t, e in rows if u == user and e == name and t >= at), default=None) if at else None
        at = found if found and found <= at + within else None
        out.append(at)
    return tuple(out)


@pytest.mark.parametrize("max_rows", [5, 40, 10_000])
def test_funnel_equals_walking(spark, max_rows):
    rng = random.Random(9)
    rows = [
        (rng.choice(["hot"] * 5 + ["a", "b"]), T0 + dt.timedelta(minutes=rng.randrange(600)), rng.choice("sxyz"))
        for _ in range(250)
    ]
    df = spark.createDataFrame(rows, "u string, t timestamp_ntz, e string")
    steps = [("x", dt.timedelta(minutes=15)), ("y", dt.timedelta(minutes=30)), ("z", dt.timedelta(hours=2))]
    conditions = {name: (F.col("e") == name, within) for name, within in steps}
    got = funnel(df, "u", "t", F.col("e") == "s", conditions, max_rows)
    expected = sorted(((u, t, *walk(rows, u, t, steps)) for u, t, e in rows if e == "s"), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == expected
    counts = funnel_counts(got, ["x", "y", "z"]).first()
    assert tuple(counts) == (len(expected), *[sum(r[i] is not None for r in expected) for i in (2, 3, 4)])
    assert counts.z > 3


def test_funnel_of_an_event_that_is_several_steps(spark):
    df = spark.createDataFrame([("a", T0, 1), ("a", T0 + dt.timedelta(hours=1), 2)], "u string, t timestamp_ntz, n int")
    any_event = (F.lit(True), dt.timedelta(hours=1))
    row = funnel(df, "u", "t", F.col("n") == 1, {"p": any_event, "q": (F.col("n") == 2, dt.timedelta(hours=1))}).first()
    assert tuple(row) == ("a", T0, T0, T0 + dt.timedelta(hours=1))
    late = funnel(df, "u", "t", F.col("n") == 1, {"q": (F.col("n") == 2, dt.timedelta(minutes=59)), "p": any_event}).first()
    assert tuple(late) == ("a", T0, None, None)


def test_means(spark):
    rng = random.Random(2)
    offset = 1e9  # variances must not drown in large means
    rows = [(c, n % 7, offset + rng.gauss(m, s)) for c, m, s, k in (("control", 0, 1, 90), ("treatment", 0.5, 3, 40)) for n in range(k)]
    rows += [("control", 3, None), ("treatment", 8, float("nan"))]
    df = spark.createDataFrame(rows, "cell string, day int, v double")
    merged = merge_moments(moments(df, ["cell", "day"], F.col("v")), ["cell"])
    got = compare_means(merged, "cell").first()
    a, b = ([v for c, _, v in rows if c == name and v == v and v is not None] for name in ("control", "treatment"))
    ma, mb = math.fsum(a) / len(a), math.fsum(b) / len(b)
    va, vb = (math.fsum((x - m) ** 2 for x in xs) / (len(xs) - 1) for xs, m in ((a, ma), (b, mb)))
    ea, eb = va / len(a), vb / len(b)
    assert (got.control_n, got.treatment_n) == (90, 40)
    assert got.control_variance == pytest.approx(va, rel=1e-6) and got.treatment_variance == pytest.approx(vb, rel=1e-6)
    assert got.t == pytest.approx((mb - ma) / math.sqrt(ea + eb), rel=1e-5)
    assert got.degrees == pytest.approx((ea + eb) ** 2 / (ea**2 / 89 + eb**2 / 39), rel=1e-5)


def test_means_without_spread_or_rows(spark):
    def compared(rows):
        df = spark.createDataFrame(rows, "cell string, v double")
        return compare_means(merge_moments(moments(df, ["cell"], F.col("v")), ["cell"]), "cell").first()

    flat = compared([("control", 1.0)] * 3 + [("treatment", 2.0)] * 3)
    assert (flat.control_variance, flat.difference, flat.t, flat.degrees) == (0.0, 1.0, None, None)
    one = compared([("control", 1.0), ("control", 3.0), ("treatment", 2.0)])
    assert (one.treatment_n, one.treatment_mean, one.treatment_variance, one.t) == (1, 2.0, None, None)
    none = compared([("control", 1.0), ("treatment", None)])
    assert (none.control_n, none.treatment_n, none.treatment_mean, none.difference) == (1, 0, None, None)
    assert tuple(compared([]))[:2] == (0, None)
