"""Sessions of events and averages over them (batch form)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import add_interval

MICROS = dt.timedelta(microseconds=1)


def sessionize(
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    gap: dt.timedelta,
    start_col: str = "session_start",
    end_col: str = "session_end",
    count_col: str = "events_in_session",
) -> DataFrame:
    """Sessions per key: events at most ``gap`` apart; a session ends ``gap`` after its last.

    Time is first cut into slots one gap long. All events of a key in one slot belong to
    one session, so they are reduced to (first, last, count) with map-side combine, and
    only slots are put in order. A key of any size has at most one row per slot left, so
    its window is bounded by the time span, not by its events. Rows without a time are
    dropped, as Spark's ``session_window`` does.
    """
    slot = F.window(ts, f"{gap // MICROS} microseconds")["start"]
    slots = (
        events.where(F.col(ts).isNotNull())
        .groupBy(*keys, slot.alias("_slot"))
        .agg(
            F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")
        )
    )
    by_slot = Window.partitionBy(*keys).orderBy("_slot")
    opens = F.col("_first") > add_interval(F.lag("_last").over(by_slot), gap)
    return (
        slots.withColumn("_opens", F.when(opens, 1).otherwise(0))
        .withColumn(
            "_session", F.sum("_opens").over(by_slot.rowsBetween(Window.unboundedPreceding, 0))
        )
        .groupBy(*keys, "_session")
        .agg(
            F.min("_first").alias(start_col),
            add_interval(F.max("_last"), gap).alias(end_col),
            F.sum("_n").alias(count_col),
        )
        .drop("_session")
    )


def average_events(
    sessions: DataFrame,
    condition: Column,
    metric: str,
    count_col: str = "events_in_session",
    out: str = "avg_events_per_session",
) -> DataFrame:
    """One labelled row: average events per session over the sessions that match."""
    return sessions.where(condition).agg(F.avg(count_col).alias(out)).select(
        F.lit(metric).alias("metric"), out
    )


def average_events_by_host(
    sessions: DataFrame,
    hosts: Sequence[str],
    host_col: str = "host",
    count_col: str = "events_in_session",
    out: str = "avg_events_per_session",
) -> DataFrame:
    """Average events per session of each listed host."""
    return (
        sessions.where(F.col(host_col).isin(*hosts))
        .groupBy(host_col)
        .agg(F.avg(count_col).alias(out))
    )
