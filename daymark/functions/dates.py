"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def as_column(value: Column | str) -> Column:
    """A column name or a column, as a column."""
    return F.col(value) if isinstance(value, str) else value


def day_of(ts: Column | str) -> Column:
    """Calendar day of a timestamp, or of ISO text holding one.

    On a ``timestamp_ntz`` column the first cast disappears, and Catalyst turns a
    comparison with a literal day into a range that reaches the Parquet scan.
    """
    return as_column(ts).cast("timestamp_ntz").cast("date")


def month_of(day: Column | str) -> Column:
    """First day of the month, as a DATE."""
    return F.trunc(as_column(day), "MM")


def day_index(day: Column | str) -> Column:
    """Zero-based day of the month."""
    return F.dayofmonth(as_column(day)) - 1


def day_literal(day: dt.date | str) -> Column:
    return F.lit(str(day)).cast("date")


def add_interval(ts: Column | str, step: dt.timedelta) -> Column:
    """``ts`` moved by a fixed interval; keeps the type of ``ts``."""
    return as_column(ts) + F.lit(step)
