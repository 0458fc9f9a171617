"""Distinct visitors of any stretch of days, from stored daily bitmaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.bitmaps import count_distinct, daily_bitmaps, period_changes, rolling_distinct
from ..session import new_path
from ..sources.readers import read_parquet
from ..sources.writers import write_snapshot
from .inputs import TODAY, web_events

FIRST_DAY = dt.date(2024, 1, 1)
#: Days of each window.
WINDOWS = {"daily": 1, "weekly": 7, "monthly": 28}


def _stored(spark: SparkSession, folder: str, wide: bool = False) -> DataFrame:
    """The daily bitmaps per host, written and read back: all that the counts below see.

    ``wide`` spreads the user numbers over a large range on both sides of zero, and takes the
    bitmaps for ids that lie far apart.
    """
    events, path = web_events(spark, folder), new_path(spark, "bitmaps")
    if wide:
        events = events.withColumn("user_id", F.col("user_id") * 1_000_003 - 75_000_000)
    write_snapshot(daily_bitmaps(events, "user_id", "ts", ["host"], spread=wide), path, "day")
    return read_parquet(spark, path)


def rolling_active_users(spark: SparkSession, folder: str) -> DataFrame:
    """Users active on each day, in the last 7 and in the last 28 days, over all hosts."""
    return rolling_distinct(_stored(spark, folder), WINDOWS, FIRST_DAY, TODAY)


def rolling_active_users_by_host(spark: SparkSession, folder: str) -> DataFrame:
    """The same per host, with user numbers in many buckets."""
    return rolling_distinct(_stored(spark, folder, wide=True), WINDOWS, FIRST_DAY, TODAY, ["host"])


def users_by_host_and_month(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct users per host and calendar month."""
    month = F.trunc("day", "MM").alias("month")
    return count_distinct(_stored(spark, folder), ["host", month], "users")


def weekly_user_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Active, retained, arrived and lost users per week."""
    week = F.to_date(F.date_trunc("week", F.col("day")))
    return period_changes(_stored(spark, folder, wide=True), week, F.date_add("week", 7), out="week")


QUERIES = {
    "rolling_active_users": rolling_active_users,
    "rolling_active_users_by_host": rolling_active_users_by_host,
    "users_by_host_and_month": users_by_host_and_month,
    "weekly_user_changes": weekly_user_changes,
}

_ROLLING = """
    WITH days AS (
      SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS day),
    seen AS (SELECT DISTINCT user_id, {key} AS host, CAST(ts AS DATE) AS day FROM events)
    SELECT {out} days.day,
           count(DISTINCT user_id) FILTER (WHERE seen.day = days.day) AS daily,
           count(DISTINCT user_id) FILTER (WHERE seen.day > days.day - 7) AS weekly,
           count(DISTINCT user_id) AS monthly
    FROM days {hosts} LEFT JOIN seen ON seen.day BETWEEN days.day - 27 AND days.day {on}
    GROUP BY ALL
"""

ORACLES = {
    "rolling_active_users": _ROLLING.format(key="''", out="", hosts="", on=""),
    "rolling_active_users_by_host": _ROLLING.format(
        key="event_type", out="hosts.host,", hosts="CROSS JOIN (SELECT DISTINCT event_type AS host FROM events) hosts",
        on="AND seen.host = hosts.host",
    ),
    "users_by_host_and_month": """
        SELECT event_type AS host, CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS users
        FROM events GROUP BY ALL
    """,
    "weekly_user_changes": """
        WITH active AS (SELECT DISTINCT user_id, CAST(date_trunc('week', ts) AS DATE) AS week FROM events),
        sides AS (
          SELECT user_id, week, 1 AS now, 0 AS before FROM active
          UNION ALL SELECT user_id, CAST(week + INTERVAL 7 DAY AS DATE), 0, 1 FROM active),
        users AS (SELECT user_id, week, max(now) AS now, max(before) AS before FROM sides GROUP BY ALL)
        SELECT week, sum(now)::BIGINT AS active, sum(now * before)::BIGINT AS retained,
               sum(now * (1 - before))::BIGINT AS arrived, sum(before * (1 - now))::BIGINT AS lost
        FROM users GROUP BY week
    """,
}
