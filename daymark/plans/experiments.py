"""Experiment metrics over events and conversations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import day_of
from ..operators import experiments
from .inputs import table, web_events

CONVERSION_TIME = dt.timedelta(days=7)
MESSAGE_TIME = dt.timedelta(hours=72)
EARLY_TIME = dt.timedelta(days=14)
RETENTION_WEEK = 4
MESSAGES = 3
SALT = "follow-module"


def _conversions(spark: SparkSession, folder: str, within: dt.timedelta) -> DataFrame:
    host = F.col("host")
    return experiments.conversions(
        web_events(spark, folder), "user_id", "ts", host == "signup", host == "purchase", within
    )


def conversion_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every sign-up with its first purchase within seven days."""
    return _conversions(spark, folder, CONVERSION_TIME)


def conversion_rate_72h(spark: SparkSession, folder: str) -> DataFrame:
    """Share of sign-ups followed by a purchase within 72 hours, by day of the sign-up."""
    starts = _conversions(spark, folder, MESSAGE_TIME)
    return experiments.conversion_rate(starts.withColumn("day", day_of("started_at")), ["day"])


def early_actions(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks, views and purchases of every user in the first 14 days."""
    actions = F.col("host").isin("click", "view", "purchase")
    return experiments.early_actions(
        web_events(spark, folder), "user_id", "ts", actions, EARLY_TIME
    )


def week_4_retention(spark: SparkSession, folder: str) -> DataFrame:
    """Users active in their fourth week, by first day."""
    return experiments.weekly_retention(
        web_events(spark, folder), "user_id", day_of("ts"), RETENTION_WEEK, F.col("first_day")
    )


def continued_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Share of conversations with more than three messages."""
    return experiments.continued_share(table(spark, folder, "conversations"), "conv_id", MESSAGES)


def _user_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Every user with their cell and whether a sign-up of theirs led to a purchase."""
    users = (
        conversion_events(spark, folder)
        .groupBy("user_id")
        .agg(F.max("converted").alias("converted"))
    )
    return users.withColumn("cell", experiments.cell("user_id", SALT))


def cell_allocation(spark: SparkSession, folder: str) -> DataFrame:
    """The cell of every customer."""
    return table(spark, folder, "customer").select(
        "c_custkey", experiments.cell("c_custkey", SALT).alias("cell")
    )


def cell_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Conversion of the two cells, with the z statistic of the difference."""
    result = experiments.compare_cells(_user_cells(spark, folder), "cell", F.col("converted"))
    return result.withColumn("z", F.round("z", 9))


#: Steps after a sign-up: their event, and the time allowed since the step before.
STEPS = {
    "click": ("click", dt.timedelta(days=3)),
    "view": ("view", dt.timedelta(hours=36)),
    "purchase": ("purchase", dt.timedelta(days=7)),
}


def three_step_funnel(spark: SparkSession, folder: str) -> DataFrame:
    """Every sign-up with its click, the view after that and the purchase after that."""
    host = F.col("host")
    steps = {name: (host == event, within) for name, (event, within) in STEPS.items()}
    return experiments.funnel(web_events(spark, folder), "user_id", "ts", host == "signup", steps)


def funnel_by_day(spark: SparkSession, folder: str) -> DataFrame:
    """Sign-ups of a day and how many of them reached each step."""
    started = three_step_funnel(spark, folder).withColumn("day", day_of("started_at"))
    return experiments.funnel_counts(started, list(STEPS), ["day"])


def cell_means(spark: SparkSession, folder: str) -> DataFrame:
    """The mean account value of customers of the two cells, from moments kept per nation."""
    customers = table(spark, folder, "customer").withColumn("cell", experiments.cell("c_custkey", SALT))
    parts = experiments.moments(customers, ["cell", "c_nationkey"], F.col("c_acctbal"))
    result = experiments.compare_means(experiments.merge_moments(parts, ["cell"]), "cell")
    # Sums of doubles depend on their order in the last digits.
    doubles = [name for name, kind in result.dtypes if kind == "double"]
    return result.withColumns({name: F.round(name, 6) for name in doubles})


QUERIES = {
    "three_step_funnel": three_step_funnel,
    "funnel_by_day": funnel_by_day,
    "cell_means": cell_means,
    "conversion_within_7_days": conversion_events,
    "conversion_rate_72h": conversion_rate_72h,
    "early_actions_14_days": early_actions,
    "week_4_retention": week_4_retention,
    "continued_conversations": continued_conversations,
    "cell_allocation": cell_allocation,
    "cell_comparison": cell_comparison,
}

_CONVERTED = """
    reached AS (
      SELECT s.user_id, s.event_id, s.ts AS started_at, min(p.ts) AS converted_at
      FROM events s LEFT JOIN events p
        ON p.user_id = s.user_id AND p.event_type = 'purchase'
       AND p.ts BETWEEN s.ts AND s.ts + INTERVAL {hours} HOUR
      WHERE s.event_type = 'signup' GROUP BY s.user_id, s.event_id, s.ts)
"""

_CELL = """
    CASE WHEN CAST('0x' || substr(md5('follow-module:' || CAST({unit} AS VARCHAR)), 1, 8) AS BIGINT)
              % 100 < 50 THEN 'treatment' ELSE 'control' END
"""

_FUNNEL = """
    clicked AS (
      SELECT s.event_id, s.user_id, s.ts AS started_at, min(e.ts) AS click_at
      FROM events s LEFT JOIN events e ON e.user_id = s.user_id AND e.event_type = 'click'
       AND e.ts BETWEEN s.ts AND s.ts + INTERVAL 3 DAY
      WHERE s.event_type = 'signup' GROUP BY ALL),
    viewed AS (
      SELECT c.*, min(e.ts) AS view_at
      FROM clicked c LEFT JOIN events e ON e.user_id = c.user_id AND e.event_type = 'view'
       AND e.ts BETWEEN click_at AND click_at + INTERVAL 36 HOUR GROUP BY ALL),
    bought AS (
      SELECT v.*, min(e.ts) AS purchase_at
      FROM viewed v LEFT JOIN events e ON e.user_id = v.user_id AND e.event_type = 'purchase'
       AND e.ts BETWEEN view_at AND view_at + INTERVAL 7 DAY GROUP BY ALL)
"""

ORACLES = {
    "three_step_funnel": f"WITH {_FUNNEL} SELECT user_id, started_at, click_at, view_at, purchase_at FROM bought",
    "funnel_by_day": f"""
        WITH {_FUNNEL}
        SELECT CAST(started_at AS DATE) AS day, count(*) AS starts, count(click_at) AS click,
               count(view_at) AS view, count(purchase_at) AS purchase
        FROM bought GROUP BY ALL
    """,
    "cell_means": f"""
        WITH cells AS (SELECT c_acctbal AS v, {_CELL.format(unit="c_custkey")} AS cell FROM customer),
        sums AS (
          SELECT count(*) FILTER (WHERE cell = 'control') AS an, avg(v) FILTER (WHERE cell = 'control') AS am,
                 var_samp(v) FILTER (WHERE cell = 'control') AS av,
                 count(*) FILTER (WHERE cell = 'treatment') AS bn, avg(v) FILTER (WHERE cell = 'treatment') AS bm,
                 var_samp(v) FILTER (WHERE cell = 'treatment') AS bv FROM cells)
        SELECT an AS control_n, round(am, 6) AS control_mean, round(av, 6) AS control_variance,
               bn AS treatment_n, round(bm, 6) AS treatment_mean, round(bv, 6) AS treatment_variance,
               round(bm - am, 6) AS difference, round((bm - am) / sqrt(av / an + bv / bn), 6) AS t,
               round((av / an + bv / bn) ** 2 / ((av / an) ** 2 / (an - 1) + (bv / bn) ** 2 / (bn - 1)), 6) AS degrees
        FROM sums
    """,
    "conversion_within_7_days": f"""
        WITH {_CONVERTED.format(hours=168)}
        SELECT user_id, started_at, converted_at, converted_at IS NOT NULL AS converted
        FROM reached
    """,
    "conversion_rate_72h": f"""
        WITH {_CONVERTED.format(hours=72)}
        SELECT CAST(started_at AS DATE) AS day, count(*) AS starts,
               count(converted_at) AS conversions,
               count(converted_at) / CAST(count(*) AS DOUBLE) AS conversion_rate
        FROM reached GROUP BY CAST(started_at AS DATE)
    """,
    "early_actions_14_days": """
        WITH seen AS (SELECT user_id, min(ts) AS first_seen FROM events GROUP BY user_id)
        SELECT user_id, first_seen,
               count(*) FILTER (WHERE event_type IN ('click', 'view', 'purchase')
                                AND ts < first_seen + INTERVAL 14 DAY) AS actions
        FROM events JOIN seen USING (user_id) GROUP BY user_id, first_seen
    """,
    "week_4_retention": """
        WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events),
        users AS (
          SELECT user_id, first_day AS cohort,
                 bool_or(day >= first_day + 21 AND day <= first_day + 27) AS kept
          FROM days JOIN (SELECT user_id, min(day) AS first_day FROM days GROUP BY user_id)
            USING (user_id)
          GROUP BY user_id, first_day)
        SELECT cohort, count(*) AS cohort_size, count(*) FILTER (WHERE kept) AS retained,
               retained / CAST(cohort_size AS DOUBLE) AS retention_rate
        FROM users GROUP BY cohort
    """,
    "continued_conversations": """
        SELECT count(*) AS conversations, count(*) FILTER (WHERE n > 3) AS continued,
               continued / CAST(conversations AS DOUBLE) AS continued_share
        FROM (SELECT count(*) AS n FROM conversations GROUP BY conv_id)
    """,
    "cell_allocation": f"""
        SELECT c_custkey, {_CELL.format(unit="c_custkey")} AS cell FROM customer
    """,
    "cell_comparison": f"""
        WITH {_CONVERTED.format(hours=168)},
        users AS (
          SELECT {_CELL.format(unit="user_id")} AS cell, count(converted_at) > 0 AS won
          FROM reached GROUP BY user_id),
        sums AS (
          SELECT count(*) FILTER (WHERE cell = 'control') AS control_units,
                 count(*) FILTER (WHERE cell = 'control' AND won) AS control_successes,
                 count(*) FILTER (WHERE cell = 'treatment') AS treatment_units,
                 count(*) FILTER (WHERE cell = 'treatment' AND won) AS treatment_successes
          FROM users),
        rates AS (
          SELECT *, control_successes / CAST(nullif(control_units, 0) AS DOUBLE) AS control_rate,
                 treatment_successes / CAST(nullif(treatment_units, 0) AS DOUBLE) AS treatment_rate,
                 (control_successes + treatment_successes)
                   / CAST(control_units + treatment_units AS DOUBLE) AS pooled
          FROM sums)
        SELECT control_units, control_successes, treatment_units, treatment_successes,
               control_rate, treatment_rate, treatment_rate - control_rate AS lift,
               round((treatment_rate - control_rate) / nullif(sqrt(pooled * (1 - pooled)
                 * (1 / CAST(control_units AS DOUBLE) + 1 / CAST(treatment_units AS DOUBLE))), 0), 9)
                 AS z
        FROM rates
    """,
}
