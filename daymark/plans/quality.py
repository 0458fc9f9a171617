"""Checks and reporting metrics over orders and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import day_of, month_of
from ..operators import quality
from .inputs import TODAY, table, web_events
from .sessions import sessions

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# Parameters: limits of the margin and of a day's change.
LOW_MARGIN = 0.9
DAY_CHANGE = 0.3


def profit(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue, cost and profit by product type, region and month.

    The region is looked up per customer and the product type per line; both dimension
    joins are left to Spark, which broadcasts a side only below its size threshold.
    """
    places = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("region"))
    )
    orders = (
        table(spark, folder, "orders")
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "region", month_of(day_of("o_orderdate")).alias("month"))
    )
    products = table(spark, folder, "part").select(
        "p_partkey", F.col("p_type").alias("product"), "p_retailprice"
    )
    lines = (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
        .join(products, F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    money = "decimal(12,2)"
    price = F.col("l_extendedprice").cast(money)
    revenue = price * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    cost = F.col("p_retailprice").cast(money) * F.col("l_quantity").cast("decimal(6,2)")
    return quality.profit_by(lines, ["product", "region", "month"], revenue, cost)


def margin_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Groups whose margin is missing or below the limit."""
    return quality.outside_limits(profit(spark, folder), "margin", low=LOW_MARGIN)


def missing_visitor_days(spark: SparkSession, folder: str) -> DataFrame:
    """Days of the month without a hit of a visitor."""
    events = web_events(spark, folder)
    first = TODAY.replace(day=1)
    return quality.missing_days(events, ["ip"], day_of("ts"), first, TODAY)


def signup_reconciliation(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sign-ups against daily purchases."""
    events = web_events(spark, folder).withColumn("day", day_of("ts"))
    return quality.reconcile_counts(
        events.where(F.col("host") == "signup"),
        events.where(F.col("host") == "purchase"),
        ["day"],
        ("signups", "purchases"),
    )


def daily_growth(spark: SparkSession, folder: str) -> DataFrame:
    """New, active and churned purchasers per day, and the net change."""
    purchases = web_events(spark, folder).where(F.col("host") == "purchase")
    return quality.growth(
        purchases, "user_id", day_of("ts"), F.date_add("day", 1), out="day"
    )


def daily_active_users(spark: SparkSession, folder: str) -> DataFrame:
    return quality.active_users(web_events(spark, folder), "user_id", day_of("ts"), "dau", "day")


def monthly_active_users(spark: SparkSession, folder: str) -> DataFrame:
    month = month_of(day_of("ts"))
    return quality.active_users(web_events(spark, folder), "user_id", month, "mau", "month")


def activity_spikes(spark: SparkSession, folder: str) -> DataFrame:
    """Days on which the hits of a host moved by more than 30 %."""
    daily = (
        web_events(spark, folder)
        .groupBy("host", day_of("ts").alias("day"))
        .agg(F.count(F.lit(1)).alias("hits"))
    )
    return quality.spikes(daily, ["host"], "day", "hits", DAY_CHANGE)


def line_key_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines that break the key (order, line number)."""
    return quality.key_violations(
        table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def event_field_report(spark: SparkSession, folder: str) -> DataFrame:
    """Failures per rule over all events."""
    return quality.field_report(
        table(spark, folder, "events"),
        {
            "user_id is present": F.col("user_id").isNotNull(),
            "ts is present": F.col("ts").isNotNull(),
            "event_type is known": F.col("event_type").isin(*EVENT_TYPES),
            "value is over 5": F.col("value") > 5,
        },
    )


def session_field_report(spark: SparkSession, folder: str) -> DataFrame:
    """Failures per rule over all sessions."""
    return quality.field_report(
        sessions(spark, folder),
        {
            "duration is over zero": F.col("session_end") > F.col("session_start"),
            "more than one event": F.col("events_in_session") > 1,
        },
    )


QUERIES = {
    "profit_by_product_region_month": profit,
    "margin_alerts": margin_alerts,
    "missing_visitor_days": missing_visitor_days,
    "count_reconciliation": signup_reconciliation,
    "user_growth": daily_growth,
    "daily_active_users": daily_active_users,
    "monthly_active_users": monthly_active_users,
    "activity_spikes": activity_spikes,
    "key_violations": line_key_violations,
    "event_field_report": event_field_report,
    "session_field_report": session_field_report,
}

_PROFIT = """
    money AS (
      SELECT p_type AS product, r_name AS region,
             CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
             sum(CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                 * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))) AS r,
             sum(CAST(CAST(p_retailprice AS DECIMAL(12,2))
                 * CAST(l_quantity AS DECIMAL(6,2)) AS DECIMAL(18,4))) AS c
      FROM lineitem
      JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
      JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey
      GROUP BY ALL),
    profits AS (
      SELECT product, region, month, CAST(r AS DOUBLE) AS revenue, CAST(c AS DOUBLE) AS cost,
             CAST(r - c AS DOUBLE) AS profit,
             CAST(r - c AS DOUBLE) / nullif(CAST(r AS DOUBLE), 0) AS margin
      FROM money)
"""

ORACLES = {
    "profit_by_product_region_month": f"WITH {_PROFIT} SELECT * FROM profits",
    "margin_alerts": f"""
        WITH {_PROFIT} SELECT * FROM profits WHERE coalesce(margin < 0.9, true)
    """,
    "missing_visitor_days": """
        SELECT CAST(user_id AS VARCHAR) AS ip, CAST(day AS DATE) AS missing_day
        FROM (SELECT DISTINCT user_id FROM events)
        CROSS JOIN (SELECT unnest(generate_series(
            DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY)) AS day)
        WHERE (user_id, CAST(day AS DATE)) NOT IN (
            SELECT (user_id, CAST(ts AS DATE)) FROM events)
    """,
    "count_reconciliation": """
        SELECT CAST(ts AS DATE) AS day,
               count(*) FILTER (WHERE event_type = 'signup') AS signups,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
               signups - purchases AS difference, signups = purchases AS matches
        FROM events WHERE event_type IN ('signup', 'purchase') GROUP BY CAST(ts AS DATE)
    """,
    "user_growth": """
        WITH active AS (
          SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
          WHERE event_type = 'purchase'),
        starts AS (SELECT min(day) AS day FROM active GROUP BY user_id),
        ends AS (
          SELECT CAST(a.day + INTERVAL 1 DAY AS DATE) AS day FROM active a
          LEFT JOIN active b ON b.user_id = a.user_id AND b.day = a.day + INTERVAL 1 DAY
          WHERE b.user_id IS NULL),
        days AS (
          SELECT day FROM active UNION SELECT day FROM ends
          WHERE day <= (SELECT max(day) FROM active))
        SELECT day,
               (SELECT count(*) FROM starts s WHERE s.day = d.day) AS new_users,
               (SELECT count(*) FROM active a WHERE a.day = d.day) AS active_users,
               (SELECT count(*) FROM ends e WHERE e.day = d.day) AS churned_users,
               (SELECT count(*) FROM starts s WHERE s.day = d.day)
               - (SELECT count(*) FROM ends e WHERE e.day = d.day) AS net_new_users
        FROM days d
    """,
    "daily_active_users": """
        SELECT CAST(ts AS DATE) AS day, count(DISTINCT user_id) AS dau
        FROM events GROUP BY CAST(ts AS DATE)
    """,
    "monthly_active_users": """
        SELECT CAST(date_trunc('month', ts) AS DATE) AS month, count(DISTINCT user_id) AS mau
        FROM events GROUP BY ALL
    """,
    "activity_spikes": """
        WITH daily AS (
          SELECT event_type AS host, CAST(ts AS DATE) AS day, count(*) AS hits
          FROM events GROUP BY ALL)
        SELECT a.host, a.day, a.hits, b.hits AS previous_hits,
               (a.hits - b.hits) / CAST(b.hits AS DOUBLE) AS change
        FROM daily a JOIN daily b ON b.host = a.host AND b.day = a.day - 1
        WHERE abs((a.hits - b.hits) / CAST(b.hits AS DOUBLE)) > CAST(0.3 AS DOUBLE)
    """,
    "key_violations": """
        SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
        GROUP BY l_orderkey, l_linenumber
        HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
    """,
    "event_field_report": """
        WITH checked AS (
          SELECT count(*) AS n, count(*) - count(user_id) AS f1, count(*) - count(ts) AS f2,
                 count(*) - count(*) FILTER (
                   WHERE event_type IN ('click', 'error', 'purchase', 'signup', 'view')) AS f3,
                 count(*) - count(*) FILTER (WHERE value > 5) AS f4
          FROM events)
        SELECT 'user_id is present' AS rule, f1 AS failures, n AS rows_checked FROM checked
        UNION ALL SELECT 'ts is present', f2, n FROM checked
        UNION ALL SELECT 'event_type is known', f3, n FROM checked
        UNION ALL SELECT 'value is over 5', f4, n FROM checked
    """,
    "session_field_report": """
        WITH numbered AS (
          SELECT user_id, event_type, count(*) FILTER (WHERE apart) OVER (
                   PARTITION BY user_id, event_type ORDER BY ts, event_id) AS session
          FROM (SELECT *, ts - lag(ts) OVER (
                  PARTITION BY user_id, event_type ORDER BY ts, event_id)
                  > INTERVAL 6 HOUR AS apart FROM events)),
        counted AS (SELECT count(*) AS n FROM numbered GROUP BY user_id, event_type, session)
        SELECT 'duration is over zero' AS rule, CAST(0 AS BIGINT) AS failures,
               count(*) AS rows_checked FROM counted
        UNION ALL
        SELECT 'more than one event', count(*) FILTER (WHERE n = 1), count(*) FROM counted
    """,
}
