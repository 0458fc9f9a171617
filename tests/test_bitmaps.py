"""Distinct counts by bitmaps against plain counting."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daymark.operators.bitmaps import count_distinct, daily_bitmaps, merge_bitmaps, period_changes, rolling_distinct

FIRST = dt.date(2024, 2, 20)
IDS = [0, 1, -1, 32767, 32768, 32769, -32767, -32768, -32769, 65536, -65536, 10**12, -(10**12), 2**62, -(2**62)]


def facts(seed=1, count=300):
    rng = random.Random(seed)
    out = [(rng.choice("abc"), rng.choice(IDS), FIRST + dt.timedelta(days=rng.choice([0, 1, 2, 9, 10, 11, 23]))) for _ in range(count)]
    return out + [("a", None, FIRST), ("d", 7, None), (None, 5, FIRST)]


@pytest.fixture(scope="module")
def events(spark):
    rows = [(h, u, d and dt.datetime.combine(d, dt.time(13))) for h, u, d in facts()]
    return spark.createDataFrame(rows, "host string, user long, ts timestamp_ntz").cache()


def known():
    return [(h, u, d) for h, u, d in facts() if u is not None and d is not None]


def test_every_id_has_a_bit_of_its_own(spark):
    df = spark.createDataFrame([(u, dt.datetime(2024, 1, 1)) for u in IDS + IDS], "user long, ts timestamp_ntz")
    assert count_distinct(daily_bitmaps(df, "user", "ts")).first()["visitors"] == len(IDS)


def test_groups_of_any_kind(spark, events):
    bitmaps = daily_bitmaps(events, "user", "ts", ["host"])
    by_host = {r["host"]: r["visitors"] for r in count_distinct(bitmaps, ["host"]).collect()}
    assert by_host == {h: len({u for k, u, _ in known() if k == h}) for h in ("a", "b", "c", None)}
    by_month = {r["month"]: r["visitors"] for r in count_distinct(bitmaps, [F.trunc("day", "MM").alias("month")]).collect()}
    assert by_month == {m: len({u for _, u, d in known() if d.replace(day=1) == m}) for m in (dt.date(2024, 2, 1), dt.date(2024, 3, 1))}
    # Bitmaps that were merged and stored count as the days do.
    assert count_distinct(merge_bitmaps(bitmaps, ["host"])).first()["visitors"] == len({u for _, u, _ in known()})


@pytest.mark.parametrize("keys", [[], ["host"]])
def test_rolling_windows(spark, events, keys):
    last = FIRST + dt.timedelta(days=26)
    bitmaps = daily_bitmaps(events, "user", "ts", ["host"])
    got = rolling_distinct(bitmaps, {"d1": 1, "d7": 7, "d28": 28}, FIRST, last, keys).collect()
    hosts = ["a", "b", "c", None] if keys else [...]
    assert len(got) == 27 * len(hosts)
    for r in got:
        for name, days in (("d1", 1), ("d7", 7), ("d28", 28)):
            users = {u for h, u, d in known() if (not keys or h == r["host"]) and 0 <= (r["day"] - d).days < days}
            assert r[name] == len(users), (r, name)


def test_changes_between_weeks(spark, events):
    week = F.to_date(F.date_trunc("week", F.col("day")))
    got = period_changes(daily_bitmaps(events, "user", "ts", ["host"]), week, F.date_add("w", 7), out="w").collect()
    active = {}
    for _, u, d in known():
        active.setdefault(d - dt.timedelta(days=d.weekday()), set()).add(u)
    weeks = set(active) | {w + dt.timedelta(days=7) for w in active}
    assert {r["w"] for r in got} == weeks
    for r in got:
        now, before = active.get(r["w"], set()), active.get(r["w"] - dt.timedelta(days=7), set())
        assert (r["active"], r["retained"], r["arrived"], r["lost"]) == (len(now), len(now & before), len(now - before), len(before - now))


def test_no_events(spark, events):
    none = daily_bitmaps(events.limit(0), "user", "ts", ["host"])
    assert count_distinct(none, ["host"]).collect() == [] and count_distinct(none).first()["visitors"] == 0
    assert rolling_distinct(none, {"d1": 1}, FIRST, FIRST).collect() == []


def test_the_shuffle_carries_bitmaps_and_not_events(spark, events):
    plan = daily_bitmaps(events, "user", "ts")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_bitmap_construct_agg" in plan


@pytest.fixture
def spread(events):
    return daily_bitmaps(events, "user", "ts", ["host"], spread=True)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_bitmaps_of_spread_ids_count_alike(spark, events, spread):
    plain = daily_bitmaps(events, "user", "ts", ["host"])
    df = spark.createDataFrame([(u, dt.datetime(2024, 1, 1)) for u in IDS + IDS + [63, 64, -64, -65]], "user long, ts timestamp_ntz")
    assert count_distinct(daily_bitmaps(df, "user", "ts", spread=True)).first()["visitors"] == len(IDS) + 4
    last, windows = FIRST + dt.timedelta(days=26), {"d1": 1, "d7": 7, "d28": 28}
    week = F.to_date(F.date_trunc("week", F.col("day")))
    for count in (
        lambda b: count_distinct(b, ["host"]),
        lambda b: count_distinct(merge_bitmaps(b, ["host"])),
        lambda b: rolling_distinct(b, windows, FIRST, last, ["host"]),
        lambda b: rolling_distinct(b, windows, FIRST, last),
        lambda b: period_changes(b, week, F.date_add("w", 7), ["host"], "w"),
        lambda b: period_changes(b, week, F.date_add("w", 7), out="w"),
        lambda b: rolling_distinct(b.limit(0), windows, FIRST, FIRST),
        lambda b: count_distinct(b.limit(0)),
    ):
        assert count(spread).schema.simpleString() == count(plain).schema.simpleString()
        assert rows_of(count(spread)) == rows_of(count(plain))


def test_bitmaps_of_spread_ids_are_small_and_merged_without_a_sort(spread):
    assert spread.schema["bitmap"].dataType.simpleString() == "bigint"
    week = F.to_date(F.date_trunc("week", F.col("day")))
    changes = period_changes(spread, week, F.date_add("w", 7), out="w")
    assert "Sort" not in changes._jdf.queryExecution().executedPlan().toString()
