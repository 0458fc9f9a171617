"""Cumulative activity: date lists, 32-bit activity bitmaps and month arrays."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.arrays import (
    active_between,
    active_days,
    bit_text,
    day_bits,
    place_at,
    prepend,
    spread_by_index,
)
from ..functions.dates import day_index, day_literal, day_of, month_of
from .joins import full_join

Day = dt.date | str


def active_keys(
    events: DataFrame, keys: Sequence[str], ts: str, day: Day, out: str = "date_active"
) -> DataFrame:
    """Distinct keys seen on one day."""
    return (
        events.where(day_of(ts) == day_literal(day))
        .select(*keys, day_of(ts).alias(out))
        .distinct()
    )


def device_keys(
    events: DataFrame, devices: DataFrame, user: str, device: str, label: str, ts: str, day: Day
) -> DataFrame:
    """Distinct (user, device label) seen on one day; events without a user are left out.

    Events are reduced to distinct (user, device) pairs before the join, so a device or
    user with very many events reaches the join as a few rows.
    """
    seen = (
        active_keys(events.where(F.col(user).isNotNull()), [user, device], ts, day)
        .join(devices.select(device, label), device)
        .select(user, label, "date_active")
    )
    return seen.distinct()


def cumulate_dates(
    yesterday: DataFrame,
    today: DataFrame,
    keys: Sequence[str],
    list_col: str,
    date_col: str,
    active_col: str = "date_active",
    carry: str = "advance",
) -> DataFrame:
    """One daily step of a cumulative date list, newest day first.

    ``yesterday`` has one row per key with its list and as-of date, ``today`` one row per
    key seen today. A key not seen today keeps its list; its date moves on a day with
    ``carry="advance"`` and stays with ``carry="keep"``. Both sides hold one row per key,
    so the full outer join cannot be skewed by a busy key.
    """
    if carry not in ("advance", "keep"):
        raise ValueError("carry must be 'advance' or 'keep'")
    old_date = F.col(f"_old_{date_col}")
    carried = F.date_add(old_date, 1) if carry == "advance" else old_date
    old = yesterday.select(
        *keys, F.col(list_col).alias("_old_list"), F.col(date_col).alias(f"_old_{date_col}")
    )
    new = today.select(*keys, F.col(active_col).alias("_active"))
    return full_join(new, old, keys).select(
        *keys,
        prepend(F.col("_active"), F.col("_old_list")).alias(list_col),
        F.coalesce(F.col("_active"), carried).alias(date_col),
    )


def date_lists(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    through: Day,
    list_col: str,
    date_col: str,
) -> DataFrame:
    """Date lists of all days up to ``through`` at once: the result of daily steps.

    Rows are first made distinct per key and day (combined before the shuffle), so a list
    is gathered from at most one row per calendar day.
    """
    days = events.where(day_of(ts) <= day_literal(through)).select(*keys, day_of(ts).alias("_day"))
    return (
        days.distinct()
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("_day"), asc=False).alias(list_col))
        .withColumn(date_col, day_literal(through))
    )


def date_list_snapshots(
    before: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    first: Day,
    last: Day,
    list_col: str,
    date_col: str,
) -> DataFrame:
    """The date-list snapshots of every day from ``first`` to ``last``, in one pass.

    ``before`` is the snapshot of the day before ``first``. Equals running
    :func:`cumulate_dates` day after day. A key's new days, at most one per calendar day, are
    gathered once; each snapshot takes those up to its day, newest first, before the old list.
    A key has a row from the first day on if it is in ``before``, else from its first new day.
    NULL keys are equal to each other.
    """
    start, end = day_literal(first), day_literal(last)
    new = events.where(day_of(ts).between(start, end)).select(*keys, day_of(ts).alias("_day"))
    days = new.distinct().groupBy(*keys).agg(F.collect_list("_day").alias("_days"))
    none = F.lit(None)
    kind = before.schema[list_col].dataType
    both = before.select(*keys, F.col(list_col).alias("_old"), none.cast(kind).alias("_days")).unionByName(
        days.select(*keys, none.cast(kind).alias("_old"), "_days")
    )
    # One row per key and side, so a key's rows meet without a join and NULL keys do as well.
    merged = both.groupBy(*keys).agg(
        F.max("_old").alias("_old"), F.sort_array(F.max("_days"), asc=False).alias("_days")
    )
    begin = F.when(F.col("_old").isNotNull(), start).otherwise(F.array_min("_days"))
    dated = merged.select("*", F.explode(F.sequence(begin, end)).alias(date_col))
    seen = F.filter(F.coalesce("_days", F.array().cast(kind)), lambda d: d <= F.col(date_col))
    old = F.coalesce("_old", F.array().cast(kind))
    return dated.select(*keys, F.concat(seen, old).alias(list_col), date_col)


def datelist_bits(
    df: DataFrame,
    list_col: str,
    as_of: Column,
    top_exponent: int = 31,
    window: int = 32,
    out: str = "datelist_int",
    text_out: str | None = "datelist_bits",
) -> DataFrame:
    """32-bit activity map of a date list; the top bit is the as-of day.

    It is computed within the row: no calendar join and no shuffle. ``top_exponent=32``
    with ``window=31`` gives the older coding, in which the as-of day falls out of the 32
    bits and the top bit is the day before.
    """
    result = df.withColumn(out, day_bits(list_col, as_of, window, top_exponent))
    return result.withColumn(text_out, bit_text(F.col(out))) if text_out else result


def activity_states(df: DataFrame, bits: str, period: int = 7) -> DataFrame:
    """What a 32-day activity map (top bit = as-of day) says, with bit operations alone.

    Adds ``active_1``, ``active_7``, ``active_28``, the number of active days of the last 28,
    and ``state`` over periods of so many days: of a user active in the last one "retained" (the
    one before as well), "resurrected" (only some day before that) or "new" (no other day in
    the map); else "churned" (active in the one before) or "stale".
    """
    if not 1 <= period <= 15:
        raise ValueError("a map of 32 days holds two periods of up to 15 days and a day before them")
    one = F.col(bits)
    now, before = active_between(one, 0, period - 1), active_between(one, period, 2 * period - 1)
    ever = active_between(one, 2 * period, 31)
    state = (
        F.when(now & before, "retained")
        .when(now & ever, "resurrected")
        .when(now, "new")
        .when(before, "churned")
        .otherwise("stale")
    )
    spans = {f"active_{n}": active_between(one, 0, n - 1) for n in (1, 7, 28)}
    return df.withColumns({**spans, "days_of_28": active_days(one, 0, 27), "state": state})


def daily_metrics(
    events: DataFrame,
    keys: Sequence[str],
    ts: str,
    visitor: str,
    day: Day | None = None,
    out: str = "day",
) -> DataFrame:
    """Hits and distinct visitors per key and day, of one day or of all.

    Spark counts the distinct visitors by first grouping on (key, day, visitor), which
    spreads a busy key over all tasks.
    """
    if day is not None:
        events = events.where(day_of(ts) == day_literal(day))
    return events.groupBy(*keys, day_of(ts).alias(out)).agg(
        F.count(F.lit(1)).alias("hits"), F.countDistinct(visitor).alias("unique_visitors")
    )


def reduce_month(
    month: DataFrame,
    daily: DataFrame,
    keys: Sequence[str],
    day: Day,
    metrics: Mapping[str, str],
    month_col: str = "month_start",
) -> DataFrame:
    """Put one day's metrics into the month arrays.

    ``month`` has one row per key with the arrays so far, ``daily`` one row per key seen on
    ``day``, ``metrics`` maps array columns to daily columns. A value goes to the index of
    its day, so running a day twice changes nothing and a skipped day leaves a 0.
    """
    at = day_index(day_literal(day))
    start = month_of(day_literal(day))
    old = month.where(F.col(month_col) == start).select(*keys, *metrics)
    new = daily.select(*keys, *[F.col(m).alias(f"_new_{a}") for a, m in metrics.items()])
    return full_join(old, new, keys).select(
        start.alias(month_col),
        *keys,
        *[place_at(F.col(a), at, F.col(f"_new_{a}")).alias(a) for a in metrics],
    )


def reduce_month_full(
    daily: DataFrame,
    keys: Sequence[str],
    through: Day,
    metrics: Mapping[str, str],
    day_col: str = "day",
    month_col: str = "month_start",
) -> DataFrame:
    """Month arrays of all days up to ``through``: the result of daily steps.

    A month gathers at most 31 rows per key.
    """
    last = F.least(F.last_day(month_col), day_literal(through))
    entry = F.struct(
        day_index(day_col).alias("index"), *[F.col(m).alias(m) for m in metrics.values()]
    )
    return (
        daily.where(F.col(day_col) <= day_literal(through))
        .groupBy(month_of(day_col).alias(month_col), *keys)
        .agg(F.collect_list(entry).alias("_days"))
        .select(
            month_col,
            *keys,
            *[
                spread_by_index(F.col("_days"), m, F.dayofmonth(last)).alias(a)
                for a, m in metrics.items()
            ],
        )
    )


def merge_months(
    stored: DataFrame | None,
    daily: DataFrame,
    keys: Sequence[str],
    first: dt.date,
    last: dt.date,
    metrics: Mapping[str, str],
    day_col: str = "day",
    month_col: str = "month_start",
) -> DataFrame:
    """Put the metrics of all days from ``first`` to ``last`` into the month arrays at once.

    ``stored`` holds the arrays of the months that the days fall in (None if there are none),
    ``daily`` one row per key and day of the range. Equals :func:`reduce_month` day after day:
    days of the range take the new value or 0, other days keep theirs, and an array reaches
    the last day of the range that lies in its month. NULL keys are equal to each other.
    """
    entry = F.struct(day_index(day_col).alias("index"), *[F.col(m) for m in metrics.values()])
    new = daily.groupBy(month_of(day_col).alias(month_col), *keys).agg(
        F.collect_list(entry).alias("_days")
    )
    both = new.select(month_col, *keys, "_days", *[F.lit(None).cast("array<bigint>").alias(a) for a in metrics])
    if stored is not None:
        old = stored.select(
            month_col, *keys, F.lit(None).cast(new.schema["_days"].dataType).alias("_days"), *metrics
        )
        both = both.unionByName(old)
    # At most one row per key and side: they are put together without a join.
    merged = both.groupBy(month_col, *keys).agg(
        F.max_by("_days", F.size("_days")).alias("_days"),
        *[F.max_by(a, F.size(a)).alias(a) for a in metrics],
    )
    low = F.greatest(F.datediff(day_literal(first), month_col), F.lit(0))
    high = F.dayofmonth(F.least(F.last_day(month_col), day_literal(last))) - 1
    arrays = []
    for name, metric in metrics.items():
        fresh = spread_by_index(F.coalesce("_days", F.array().cast(new.schema["_days"].dataType)), metric, high + 1)
        length = F.greatest(F.coalesce(F.size(name), F.lit(0)), high + 1)
        places = F.zip_with(F.sequence(F.lit(0), length - 1), fresh, lambda i, f: F.struct(i.alias("i"), f.alias("f")))
        arrays.append(F.transform(places, _taken(F.col(name), low, high)).alias(name))
    return merged.select(month_col, *keys, *arrays)


def _taken(old: Column, low: Column, high: Column):
    """The new value of a place in the range, else the old one, else 0."""
    zero = F.lit(0).cast("bigint")
    return lambda place: F.when(place["i"].between(low, high), place["f"]).otherwise(
        F.coalesce(F.get(old, place["i"]), zero)
    )
