"""Cumulative activity of users, devices and hosts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import day_literal, day_of
from ..operators.activity import (
    active_keys,
    activity_states,
    cumulate_dates,
    daily_metrics,
    date_lists,
    datelist_bits,
    device_keys,
    reduce_month,
    reduce_month_full,
)
from .inputs import TODAY, YESTERDAY, devices, web_events

LIST, DATE = "activity_dates", "as_of"
MONTH_METRICS = {"hit_array": "hits", "unique_visitors_array": "unique_visitors"}


def _joined(df: DataFrame, *lists: str) -> DataFrame:
    """Arrays as text, so that results compare the same on every engine."""
    return df.withColumns(
        {c: F.concat_ws(",", F.transform(c, lambda v: v.cast("string"))) for c in lists}
    )


def _host_step(spark: SparkSession, folder: str, key: str, carry: str) -> DataFrame:
    events = web_events(spark, folder)
    yesterday = date_lists(events, [key], "ts", YESTERDAY, LIST, DATE)
    today = active_keys(events, [key], "ts", TODAY)
    return cumulate_dates(yesterday, today, [key], LIST, DATE, carry=carry)


def host_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Date list per host after today's step."""
    return _joined(_host_step(spark, folder, "host", "advance"), LIST)


def visitor_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Date list per visitor; visitors not seen today are carried to today."""
    return _joined(_host_step(spark, folder, "ip", "advance"), LIST)


def visitor_activity_kept(spark: SparkSession, folder: str) -> DataFrame:
    """The same, with the date of visitors not seen today left unchanged."""
    return _joined(_host_step(spark, folder, "ip", "keep"), LIST)


def _device_lists(spark: SparkSession, folder: str) -> DataFrame:
    events, dims = web_events(spark, folder), devices(spark, folder)
    keys = ["user_id", "browser_type"]
    # Reduced to one row per user, device and day before the device join.
    past = (
        events.where(day_of("ts") <= day_literal(YESTERDAY))
        .select("user_id", "device_id", day_of("ts").alias("day"))
        .distinct()
        .join(dims, "device_id")
    )
    yesterday = date_lists(past, keys, "day", YESTERDAY, LIST, DATE)
    today = device_keys(events, dims, "user_id", "device_id", "browser_type", "ts", TODAY)
    return cumulate_dates(yesterday, today, keys, LIST, DATE).withColumn(
        "user_id", F.col("user_id").cast("string")
    )


def user_device_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Date list per user and browser after today's step."""
    return _joined(_device_lists(spark, folder), LIST)


def datelist_bitmap(spark: SparkSession, folder: str) -> DataFrame:
    """Activity of the last 32 days per user and browser as bits."""
    bits = datelist_bits(_device_lists(spark, folder), LIST, F.col(DATE))
    return bits.select("user_id", "browser_type", "datelist_int", "datelist_bits")


def datelist_bitmap_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """The older coding, one bit higher: today's bit lies outside the 32."""
    bits = datelist_bits(
        _device_lists(spark, folder), LIST, F.col(DATE), top_exponent=32, window=31
    )
    return bits.select("user_id", "browser_type", "datelist_int", "datelist_bits")


def host_month_reduced(spark: SparkSession, folder: str) -> DataFrame:
    """Hits and visitors per host as month arrays, all days at once."""
    daily = daily_metrics(web_events(spark, folder), ["host"], "ts", "user_id")
    return _joined(reduce_month_full(daily, ["host"], TODAY, MONTH_METRICS), *MONTH_METRICS)


def visitor_month_step(spark: SparkSession, folder: str) -> DataFrame:
    """Month arrays per visitor: the month up to yesterday plus today's step."""
    events = web_events(spark, folder).withColumn("visitor", F.col("ip"))
    before = reduce_month_full(
        daily_metrics(events, ["ip"], "ts", "host"), ["ip"], YESTERDAY, MONTH_METRICS
    )
    today = daily_metrics(events, ["ip"], "ts", "host", TODAY)
    return _joined(reduce_month(before, today, ["ip"], TODAY, MONTH_METRICS), *MONTH_METRICS)


def activity_state(spark: SparkSession, folder: str) -> DataFrame:
    """Active days and state of every visitor of a host, from the stored map alone."""
    lists = date_lists(web_events(spark, folder), ["ip", "host"], "ts", TODAY, LIST, DATE)
    maps = datelist_bits(lists, LIST, F.col(DATE), text_out=None)
    return activity_states(maps, "datelist_int").drop(LIST, DATE, "datelist_int")


QUERIES = {
    "activity_state": activity_state,
    "host_activity": host_activity,
    "visitor_activity": visitor_activity,
    "visitor_activity_kept": visitor_activity_kept,
    "user_device_activity": user_device_activity,
    "datelist_bits": datelist_bitmap,
    "datelist_bits_as_written": datelist_bitmap_as_written,
    "host_month_reduced": host_month_reduced,
    "visitor_month_step": visitor_month_step,
}

_VISITOR_LISTS = """
    SELECT CAST(user_id AS VARCHAR) AS ip,
           string_agg(DISTINCT strftime(ts, '%Y-%m-%d'), ','
                      ORDER BY strftime(ts, '%Y-%m-%d') DESC) AS activity_dates,
           {as_of} AS as_of
    FROM events WHERE ts < TIMESTAMP '2024-01-31' GROUP BY user_id
"""

_BITS = """
    WITH active AS (
      SELECT DISTINCT user_id, c_mktsegment, date_diff('day', CAST(ts AS DATE), DATE '2024-01-30') AS ago
      FROM events JOIN customer ON c_custkey = user_id
      WHERE ts < TIMESTAMP '2024-01-31'),
    coded AS (
      SELECT user_id, c_mktsegment,
             CAST(sum(CASE WHEN ago < {window} THEN CAST(pow(2, {top} - ago) AS BIGINT) ELSE 0 END)
                  % 4294967296 AS BIGINT) AS bits
      FROM active GROUP BY user_id, c_mktsegment)
    SELECT CAST(user_id AS VARCHAR) AS user_id, c_mktsegment AS browser_type,
           bits AS datelist_int, lpad(bin(bits), 32, '0') AS datelist_bits
    FROM coded
"""

_MONTH = """
    WITH calendar AS (
      SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY))
                  AS DATE) AS day),
    counted AS (
      SELECT {key} AS k, CAST(ts AS DATE) AS day,
             count(*) AS hits, count(DISTINCT {visitor}) AS visitors
      FROM events GROUP BY ALL)
    SELECT DATE '2024-01-01' AS month_start, keys.k AS {out},
           string_agg(CAST(coalesce(hits, 0) AS VARCHAR), ',' ORDER BY calendar.day) AS hit_array,
           string_agg(CAST(coalesce(visitors, 0) AS VARCHAR), ',' ORDER BY calendar.day)
             AS unique_visitors_array
    FROM (SELECT DISTINCT {key} AS k FROM events) keys
    CROSS JOIN calendar
    LEFT JOIN counted ON counted.k = keys.k AND counted.day = calendar.day
    GROUP BY keys.k
"""

ORACLES = {
    "activity_state": """
        WITH seen AS (
          SELECT DISTINCT user_id, event_type, date_diff('day', CAST(ts AS DATE), DATE '2024-01-30') AS ago
          FROM events WHERE ts < TIMESTAMP '2024-01-31'),
        per AS (
          SELECT CAST(user_id AS VARCHAR) AS ip, event_type AS host,
                 count(*) FILTER (WHERE ago = 0) > 0 AS active_1, count(*) FILTER (WHERE ago < 7) > 0 AS active_7,
                 count(*) FILTER (WHERE ago < 28) > 0 AS active_28,
                 CAST(count(*) FILTER (WHERE ago < 28) AS INTEGER) AS days_of_28,
                 count(*) FILTER (WHERE ago BETWEEN 7 AND 13) > 0 AS before,
                 count(*) FILTER (WHERE ago BETWEEN 14 AND 31) > 0 AS ever
          FROM seen GROUP BY ALL)
        SELECT ip, host, active_1, active_7, active_28, days_of_28,
               CASE WHEN active_7 AND before THEN 'retained' WHEN active_7 AND ever THEN 'resurrected'
                    WHEN active_7 THEN 'new' WHEN before THEN 'churned' ELSE 'stale' END AS state
        FROM per
    """,
    "host_activity": """
        SELECT event_type AS host,
               string_agg(DISTINCT strftime(ts, '%Y-%m-%d'), ','
                          ORDER BY strftime(ts, '%Y-%m-%d') DESC) AS activity_dates,
               DATE '2024-01-30' AS as_of
        FROM events WHERE ts < TIMESTAMP '2024-01-31' GROUP BY event_type
    """,
    "visitor_activity": _VISITOR_LISTS.format(as_of="DATE '2024-01-30'"),
    "visitor_activity_kept": _VISITOR_LISTS.format(
        as_of="greatest(DATE '2024-01-29', max(CAST(ts AS DATE)))"
    ),
    "user_device_activity": """
        SELECT CAST(user_id AS VARCHAR) AS user_id, c_mktsegment AS browser_type,
               string_agg(DISTINCT strftime(ts, '%Y-%m-%d'), ','
                          ORDER BY strftime(ts, '%Y-%m-%d') DESC) AS activity_dates,
               DATE '2024-01-30' AS as_of
        FROM events JOIN customer ON c_custkey = user_id
        WHERE ts < TIMESTAMP '2024-01-31' GROUP BY user_id, c_mktsegment
    """,
    "datelist_bits": _BITS.format(top=31, window=32),
    "datelist_bits_as_written": _BITS.format(top=32, window=31),
    "host_month_reduced": _MONTH.format(key="event_type", visitor="user_id", out="host"),
    "visitor_month_step": _MONTH.format(
        key="CAST(user_id AS VARCHAR)", visitor="event_type", out="ip"
    ),
}
