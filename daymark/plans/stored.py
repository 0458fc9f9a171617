"""The jobs over stored tables as queries: each writes its tables to the shared folder, steps
them on, runs a step twice, and returns what is stored."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.analytics import duplicate_report
from ..session import new_path
from ..sources.readers import read_parquet, read_snapshot
from ..sources.writers import delete_rows, upsert, write_snapshot
from .activity import _MONTH, DATE, LIST, MONTH_METRICS, _joined
from .history import KEY, ORACLES as HISTORY, PERIOD, TRACKED, _history, _yearly
from .inputs import BACKFILL_YEAR, LAST_YEAR, TODAY, table, web_events
from .jobs import backfill_activity, backfill_months, run_activity_day, run_history_year, run_month_day, start_activity_table

#: The first day of the events.
FIRST_DAY = dt.date(2024, 1, 1)


def stored_host_activity(spark: SparkSession, folder: str) -> DataFrame:
    """Date lists per visitor: a first load, a day, the same day again, then all missing days."""
    events, path = web_events(spark, folder), new_path(spark, "activity")
    start_activity_table(events, path, ["ip"], "ts", FIRST_DAY, LIST, DATE)
    second = FIRST_DAY + dt.timedelta(days=1)
    for _ in range(2):
        run_activity_day(read_parquet(spark, path), events, path, ["ip"], "ts", second, LIST, DATE)
    backfill_activity(spark, events, path, ["ip"], "ts", LIST, DATE, FIRST_DAY, TODAY)
    return _joined(read_snapshot(spark, path, DATE, TODAY), LIST).select("ip", LIST, DATE)


def stored_host_months(spark: SparkSession, folder: str) -> DataFrame:
    """Month arrays per host: a first load, all days but the last at once, two of them over
    again, then the last day, twice."""
    events, path = web_events(spark, folder), new_path(spark, "months")
    names = (["host"], "ts", "user_id")
    run_month_day(spark, events, path, *names, FIRST_DAY, MONTH_METRICS)
    eve = TODAY - dt.timedelta(days=1)
    backfill_months(spark, events, path, *names, FIRST_DAY + dt.timedelta(days=1), eve, MONTH_METRICS)
    backfill_months(spark, events, path, *names, eve - dt.timedelta(days=1), eve, MONTH_METRICS)
    for _ in range(2):
        run_month_day(spark, events, path, *names, TODAY, MONTH_METRICS)
    return _joined(read_parquet(spark, path), *MONTH_METRICS).select("host", "month_start", *MONTH_METRICS)


def stored_history(spark: SparkSession, folder: str) -> DataFrame:
    """The type-2 table after a backfill and two runs of the next year."""
    path = new_path(spark, "history")
    write_snapshot(_history(spark, folder, BACKFILL_YEAR), path, PERIOD)
    for _ in range(2):
        run_history_year(spark, _yearly(spark, folder), path, KEY, TRACKED, PERIOD, LAST_YEAR)
    return read_snapshot(spark, path, PERIOD, LAST_YEAR)


def stored_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by year: finished ones loaded into an empty path, then all that were ever open, and
    those of a priority with a changed price."""
    path = new_path(spark, "orders")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.year("o_orderdate").alias("order_year"), "o_totalprice", "o_orderstatus", "o_orderpriority"
    )
    keys = ["o_orderkey", "order_year"]
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + F.when(urgent, 1).otherwise(0))
    upsert(spark, path, orders.where("o_orderstatus = 'F'"), keys, "order_year")
    upsert(spark, path, changed.where((F.col("o_orderstatus") != "F") | urgent), keys, "order_year")
    return read_parquet(spark, path).select("o_orderkey", "order_year", "o_totalprice")


def delete_by_subquery(spark: SparkSession, folder: str) -> DataFrame:
    """The lines left when all lines with a repeated line number are deleted."""
    lines, keys = table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    return delete_rows(lines, duplicate_report(lines, keys), keys)


QUERIES = {
    "stored_host_activity": stored_host_activity,
    "stored_host_months": stored_host_months,
    "stored_history": stored_history,
    "stored_upsert": stored_upsert,
    "delete_by_subquery": delete_by_subquery,
}

ORACLES = {
    "stored_host_activity": """
        SELECT CAST(user_id AS VARCHAR) AS ip,
               string_agg(DISTINCT strftime(ts, '%Y-%m-%d'), ','
                          ORDER BY strftime(ts, '%Y-%m-%d') DESC) AS activity_dates,
               DATE '2024-01-30' AS as_of
        FROM events WHERE ts < TIMESTAMP '2024-01-31'
        GROUP BY user_id
    """,
    "stored_host_months": _MONTH.format(
        key="event_type", visitor="user_id", out="host"
    ),
    "stored_history": HISTORY["scd2_incremental"],
    "stored_upsert": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM orders
    """,
    "delete_by_subquery": """
        SELECT * FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (
          SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """,
}
