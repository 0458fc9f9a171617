"""Daily and yearly jobs over stored tables: read the last snapshot, step, write the next.

Every job writes one partition and can run again for the same day with the same result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import day_literal, day_of, month_of
from ..operators.activity import (
    active_keys,
    cumulate_dates,
    daily_metrics,
    date_list_snapshots,
    merge_months,
    reduce_month,
    reduce_month_full,
)
from ..operators.history import scd2_increment
from ..operators.quality import missing_days
from ..session import materialize
from ..sources.readers import read_parquet, read_snapshot
from ..sources.writers import table_exists, write_snapshot

ONE_DAY = dt.timedelta(days=1)


def run_activity_day(
    stored: DataFrame,
    events: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    day: dt.date,
    list_col: str,
    date_col: str,
) -> None:
    """Write the date-list snapshot of one day from the snapshot of the day before."""
    yesterday = stored.where(F.col(date_col) == day_literal(day - ONE_DAY))
    today = active_keys(events, keys, ts, day)
    step = cumulate_dates(yesterday, today, keys, list_col, date_col)
    write_snapshot(step, path, date_col)


def start_activity_table(
    events: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    day: dt.date,
    list_col: str,
    date_col: str,
) -> None:
    """Write the first snapshot, from one day's events alone."""
    first = active_keys(events, keys, ts, day, "_day")
    write_snapshot(
        first.select(*keys, F.array("_day").alias(list_col), F.col("_day").alias(date_col)),
        path,
        date_col,
    )


def backfill_activity(
    spark: SparkSession,
    events: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    list_col: str,
    date_col: str,
    first: dt.date,
    last: dt.date,
) -> list[dt.date]:
    """Write the missing snapshots between two days, and return the days written.

    Every snapshot builds on the one before, so all days from the first missing one on are
    written again: from one read of their events and one write, see
    :func:`~daymark.operators.activity.date_list_snapshots`.
    """
    missing = missing_days(read_parquet(spark, path), [], F.col(date_col), first, last)
    start = missing.agg(F.min("missing_day")).first()[0]
    if start is None:
        return []
    # The path is read and written, in partitions of different days.
    before = read_snapshot(spark, path, date_col, start - ONE_DAY)
    steps = date_list_snapshots(before, events, keys, ts, start, last, list_col, date_col)
    write_snapshot(materialize(steps), path, date_col)
    return [start + ONE_DAY * n for n in range((last - start).days + 1)]


def run_month_day(
    spark: SparkSession,
    events: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    visitor: str,
    day: dt.date,
    metrics: Mapping[str, str],
    month_col: str = "month_start",
) -> None:
    """Put one day into the stored month arrays.

    The month is read from and written to the same partition, so the new rows are
    checkpointed in the shared folder before the write. A path without a table starts one.
    """
    daily = daily_metrics(events, keys, ts, visitor, day)
    if table_exists(spark, path):
        stored = read_parquet(spark, path).where(F.col(month_col) == month_of(day_literal(day)))
        step = reduce_month(stored, daily, keys, day, metrics, month_col)
    else:
        step = reduce_month_full(daily, keys, day, metrics, month_col=month_col)
    write_snapshot(materialize(step), path, month_col)


def backfill_months(
    spark: SparkSession,
    events: DataFrame,
    path: str,
    keys: Sequence[str],
    ts: str,
    visitor: str,
    first: dt.date,
    last: dt.date,
    metrics: Mapping[str, str],
    month_col: str = "month_start",
) -> None:
    """Put all days of a range into the stored month arrays: one read, one write.

    Gives what :func:`run_month_day` gives day after day. Days before the range stay as they are
    stored, also if nothing is.
    """
    in_range = day_of(ts).between(day_literal(first), day_literal(last))
    daily = daily_metrics(events.where(in_range), keys, ts, visitor)
    months = F.col(month_col).between(month_of(day_literal(first)), month_of(day_literal(last)))
    stored = read_parquet(spark, path).where(months) if table_exists(spark, path) else None
    step = merge_months(stored, daily, keys, first, last, metrics, month_col=month_col)
    write_snapshot(materialize(step), path, month_col)


def run_history_year(
    spark: SparkSession,
    yearly: DataFrame,
    path: str,
    key: Sequence[str],
    tracked: Sequence[str],
    period: str,
    year: int,
) -> None:
    """Write the type-2 history as of ``year`` from the one a year before."""
    history = read_snapshot(spark, path, period, year - 1)
    current = yearly.where(F.col(period) == year)
    write_snapshot(scd2_increment(history, current, key, tracked, year - 1, period), path, period)
