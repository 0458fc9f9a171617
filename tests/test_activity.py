"""Cumulative date lists, bitmaps and month arrays."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daymark.functions.arrays import LOW_32_BITS
from daymark.operators.activity import (
    active_keys,
    cumulate_dates,
    daily_metrics,
    date_lists,
    datelist_bits,
    device_keys,
    reduce_month,
    reduce_month_full,
)


def day(text):
    return dt.date.fromisoformat(text)


def at(text):
    return dt.datetime.fromisoformat(text)


USER_DEVICES = (
    "user_id string, browser_type string, device_activity_date_list array<date>, date date"
)


def device_step(spark, carry):
    stored = spark.createDataFrame(
        [
            ("user1", "chrome", [day("2023-01-31")], day("2023-01-31")),
            ("user2", "firefox", [day("2023-01-30")], day("2023-01-30")),
        ],
        USER_DEVICES,
    )
    events = spark.createDataFrame(
        [("user1", at("2023-01-31"), "dev1"), ("user2", at("2023-01-30"), "dev2")],
        "user_id string, event_time timestamp, device_id string",
    )
    devices = spark.createDataFrame(
        [("dev1", "chrome"), ("dev2", "firefox")], "device_id string, browser_type string"
    )
    today = device_keys(
        events, devices, "user_id", "device_id", "browser_type", "event_time", "2023-01-31"
    )
    return cumulate_dates(
        stored.where(F.col("date") == "2023-01-30"),
        today,
        ["user_id", "browser_type"],
        "device_activity_date_list",
        "date",
        carry=carry,
    )


def test_device_activity_list(spark):
    expected = spark.createDataFrame(
        [
            ("user1", "chrome", [day("2023-01-31")], day("2023-01-31")),
            ("user2", "firefox", [day("2023-01-30")], day("2023-01-30")),
        ],
        USER_DEVICES,
    )
    assertDataFrameEqual(device_step(spark, "keep"), expected, ignoreNullable=True)


def test_device_activity_list_moves_the_date_on(spark):
    rows = {r.user_id: r.date for r in device_step(spark, "advance").collect()}
    assert rows == {"user1": day("2023-01-31"), "user2": day("2023-01-31")}


def test_host_activity_list_with_text_times_and_timestamp_dates(spark):
    hosts = "host string, host_activity_datelist array<date>, c_date timestamp"
    stored = spark.createDataFrame(
        [(h, [day("2023-01-02")], at("2023-01-02")) for h in ("host1", "host2")], hosts
    )
    events = spark.createDataFrame(
        [("host1", "2023-01-03T09:30:00"), ("host3", "2023-01-03T10:15:00")],
        "host string, event_time string",
    )
    actual = cumulate_dates(
        stored.where(F.col("c_date") == F.lit("2023-01-02").cast("date")),
        active_keys(events, ["host"], "event_time", "2023-01-03"),
        ["host"],
        "host_activity_datelist",
        "c_date",
        carry="keep",
    )
    expected = spark.createDataFrame(
        [
            ("host1", [day("2023-01-03"), day("2023-01-02")], at("2023-01-03")),
            ("host2", [day("2023-01-02")], at("2023-01-02")),
            ("host3", [day("2023-01-03")], at("2023-01-03")),
        ],
        hosts,
    )
    assertDataFrameEqual(actual, expected, ignoreNullable=True)


def test_events_without_user_are_left_out_only_for_devices(spark):
    events = spark.createDataFrame(
        [(None, at("2023-01-01"), "d", "h"), ("u", at("2023-01-01"), "d", "h")],
        "user_id string, ts timestamp, device_id string, host string",
    )
    devices = spark.createDataFrame([("d", "b")], "device_id string, browser string")
    seen = device_keys(events, devices, "user_id", "device_id", "browser", "ts", "2023-01-01")
    assert [r.user_id for r in seen.collect()] == ["u"]
    metrics = daily_metrics(events, ["host"], "ts", "user_id").collect()
    assert [(r.hits, r.unique_visitors) for r in metrics] == [(2, 1)]


def random_events(spark, days, seed=1):
    rng = random.Random(seed)
    start = at("2024-01-20")
    rows = [
        (f"k{rng.randrange(6)}", rng.randrange(9), start + dt.timedelta(hours=rng.randrange(24 * days)))
        for _ in range(60)
    ]
    return spark.createDataFrame(rows, "k string, user_id int, ts timestamp_ntz")


def test_daily_steps_equal_the_lists_at_once(spark):
    events = random_events(spark, 6).cache()
    days = [day("2024-01-20") + dt.timedelta(days=n) for n in range(6)]
    stored = date_lists(events, ["k"], "ts", days[0], "dates", "as_of")
    for d in days[1:]:
        stored = cumulate_dates(
            stored, active_keys(events, ["k"], "ts", d), ["k"], "dates", "as_of"
        )
    at_once = date_lists(events, ["k"], "ts", days[-1], "dates", "as_of")
    assertDataFrameEqual(stored, at_once, ignoreNullable=True)


def test_keep_leaves_an_inactive_key_at_its_last_day(spark):
    events = spark.createDataFrame(
        [("a", at("2024-01-01")), ("b", at("2024-01-01")), ("b", at("2024-01-03"))],
        "k string, ts timestamp_ntz",
    )
    results = {}
    for carry in ("keep", "advance"):
        stored = date_lists(events, ["k"], "ts", "2024-01-01", "dates", "as_of")
        for d in ("2024-01-02", "2024-01-03"):
            stored = cumulate_dates(
                stored, active_keys(events, ["k"], "ts", d), ["k"], "dates", "as_of", carry=carry
            )
        results[carry] = {r.k: (len(r.dates), r.as_of) for r in stored.collect()}
    assert results["keep"] == {"a": (1, day("2024-01-01")), "b": (2, day("2024-01-03"))}
    assert results["advance"] == {"a": (1, day("2024-01-03")), "b": (2, day("2024-01-03"))}


def test_bits(spark):
    as_of = day("2023-01-31")
    ago = lambda n: as_of - dt.timedelta(days=n)
    df = spark.createDataFrame(
        [
            ("today", [ago(0)]),
            ("yesterday", [ago(1), ago(1)]),
            ("31 days", [ago(31)]),
            ("32 days", [ago(32)]),
            ("none", []),
        ],
        "name string, dates array<date>",
    )
    bits = datelist_bits(df, "dates", F.lit(as_of))
    assert {r.name: r.datelist_int for r in bits.collect()} == {
        "today": 1 << 31,
        "yesterday": 1 << 30,
        "31 days": 1,
        "32 days": 0,
        "none": 0,
    }
    texts = {r.name: r.datelist_bits for r in bits.collect()}
    assert texts["today"] == "1" + "0" * 31 and texts["none"] == "0" * 32
    older = datelist_bits(df, "dates", F.lit(as_of), top_exponent=32, window=31)
    assert {r.name: r.datelist_int for r in older.collect()} == {
        "today": (1 << 32) & LOW_32_BITS,
        "yesterday": 1 << 31,
        "31 days": 0,
        "32 days": 0,
        "none": 0,
    }


METRICS = {"hit_array": "hits", "unique_visitors_array": "unique_visitors"}


def month_steps(spark, events, days):
    month = None
    for d in days:
        daily = daily_metrics(events, ["k"], "ts", "user_id", d)
        if month is None:
            month = reduce_month_full(daily, ["k"], d, METRICS).limit(0)
        month = reduce_month(month, daily, ["k"], d, METRICS)
    return month


def test_month_steps_equal_the_month_at_once(spark):
    events = random_events(spark, 6, seed=2).cache()
    days = [day("2024-01-20") + dt.timedelta(days=n) for n in range(6)]
    at_once = reduce_month_full(
        daily_metrics(events, ["k"], "ts", "user_id"), ["k"], days[-1], METRICS
    )
    assertDataFrameEqual(month_steps(spark, events, days), at_once, ignoreNullable=True)
    again = month_steps(spark, events, [*days, days[-1], days[2]])
    assertDataFrameEqual(again, at_once, ignoreNullable=True)


def test_month_arrays_of_a_new_host_and_a_skipped_day(spark):
    events = spark.createDataFrame(
        [("old", 1, at("2024-02-01")), ("old", 2, at("2024-02-04")), ("new", 1, at("2024-02-04"))],
        "k string, user_id int, ts timestamp_ntz",
    )
    steps = month_steps(spark, events, [day("2024-02-01"), day("2024-02-04")])
    assert {r.k: (r.month_start, r.hit_array, r.unique_visitors_array) for r in steps.collect()} == {
        "old": (day("2024-02-01"), [1, 0, 0, 1], [1, 0, 0, 1]),
        "new": (day("2024-02-01"), [0, 0, 0, 1], [0, 0, 0, 1]),
    }


def test_month_arrays_cover_each_month(spark):
    events = spark.createDataFrame(
        [("a", 1, at("2024-01-31")), ("a", 1, at("2024-02-02"))],
        "k string, user_id int, ts timestamp_ntz",
    )
    daily = daily_metrics(events, ["k"], "ts", "user_id")
    rows = reduce_month_full(daily, ["k"], "2024-02-03", METRICS).collect()
    assert {r.month_start: r.hit_array for r in rows} == {
        day("2024-01-01"): [0] * 30 + [1],
        day("2024-02-01"): [0, 1, 0],
    }


@pytest.mark.parametrize("period", [1, 7, 15])
def test_states_from_maps_equal_those_from_days(spark, period):
    import random

    from daymark.operators.activity import activity_states

    rng = random.Random(period)
    maps = [0, 1, 1 << 31, (1 << 32) - 1] + [sum(1 << b for b in range(32) if rng.random() < p) for p in (0.03, 0.1, 0.5) for _ in range(40)]
    df = spark.createDataFrame([(m,) for m in maps], "m long")
    for r in activity_states(df, "m", period).collect():
        ago = [n for n in range(32) if r.m >> (31 - n) & 1]
        now, before = (any(a <= n < a + period for n in ago) for a in (0, period))
        ever = any(n >= 2 * period for n in ago)
        state = "retained" if now and before else "resurrected" if now and ever else "new" if now else "churned" if before else "stale"
        expected = (*[any(n < d for n in ago) for d in (1, 7, 28)], sum(n < 28 for n in ago), state)
        assert (r.active_1, r.active_7, r.active_28, r.days_of_28, r.state) == expected


def test_null_keys_stay_one_row_from_step_to_step(spark):
    day = dt.date(2024, 1, 1)
    keys = "host string, date_active date"
    table = spark.createDataFrame([(None, day), ("a", day)], keys).select(
        "host", F.array("date_active").alias("dates"), F.col("date_active").alias("as_of")
    )
    for n in range(1, 4):
        today = spark.createDataFrame([(None, day + dt.timedelta(days=n))], keys)
        table = cumulate_dates(table, today, ["host"], "dates", "as_of")
    assert {r.host: len(r.dates) for r in table.collect()} == {None: 4, "a": 1} and table.count() == 2
