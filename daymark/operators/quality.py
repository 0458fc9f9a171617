"""Data-quality checks and reporting metrics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.conditions import ratio
from ..functions.dates import day_literal
from .joins import full_join


def profit_by(
    facts: DataFrame, by: Sequence[Column | str], revenue: Column, cost: Column
) -> DataFrame:
    """Revenue, cost, profit and margin per group, summed exactly as decimals."""
    money = "decimal(18,4)"
    sums = facts.groupBy(*by).agg(
        F.sum(revenue.cast(money)).alias("_revenue"), F.sum(cost.cast(money)).alias("_cost")
    )
    return sums.select(
        *[c for c in sums.columns if not c.startswith("_")],
        F.col("_revenue").cast("double").alias("revenue"),
        F.col("_cost").cast("double").alias("cost"),
        (F.col("_revenue") - F.col("_cost")).cast("double").alias("profit"),
        ratio(F.col("_revenue") - F.col("_cost"), F.col("_revenue")).alias("margin"),
    )


def missing_days(
    df: DataFrame,
    keys: Sequence[str],
    day: Column,
    first: dt.date | str,
    last: dt.date | str,
    out: str = "missing_day",
) -> DataFrame:
    """Days of a range on which a key has no row. With no keys: days without any row.

    A key's days are gathered after they have been made distinct, at most one per calendar
    day, and taken from the full range within the row.
    """
    start, end = day_literal(first), day_literal(last)
    seen = df.select(*keys, F.when(day.between(start, end), day).alias("_day")).distinct()
    days = F.collect_list("_day")
    return seen.groupBy(*keys).agg(days.alias("_days")).select(
        *keys, F.explode(F.array_except(F.sequence(start, end), "_days")).alias(out)
    )


def outside_limits(
    df: DataFrame, metric: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Rows whose metric is missing or outside ``[low, high]``."""
    bad = F.col(metric).isNull()
    if low is not None:
        bad = bad | (F.col(metric) < low)
    if high is not None:
        bad = bad | (F.col(metric) > high)
    return df.where(bad)


def reconcile_counts(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    names: tuple[str, str] = ("left_count", "right_count"),
) -> DataFrame:
    """Row counts of two sources per key, their difference, and whether they match.

    Each side is counted before the join.
    """
    a, b = names
    counts = [
        side.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
        for side, name in ((left, a), (right, b))
    ]
    zero = F.lit(0).cast("bigint")
    return (
        full_join(*counts, keys)
        .select(*keys, F.coalesce(a, zero).alias(a), F.coalesce(b, zero).alias(b))
        .withColumn("difference", F.col(a) - F.col(b))
        .withColumn("matches", F.col("difference") == 0)
    )


def growth(
    activity: DataFrame, user: str, period: Column, next_period: Column, out: str = "period"
) -> DataFrame:
    """New, active and churned users per period, and the net change.

    ``next_period`` is the period after ``period`` as an expression over the column named
    ``out``. A user churns in the first period without activity after an active one.
    Activity is reduced to distinct (user, period) pairs, so a user's window has one row
    per period.
    """
    pairs = activity.select(F.col(user).alias("_user"), period.alias(out)).distinct()
    by_period = Window.partitionBy("_user").orderBy(out)
    marked = pairs.select(
        out,
        F.row_number().over(by_period).alias("_nth"),
        F.lead(out).over(by_period).alias("_following"),
        next_period.alias("_next"),
    )
    leaves = F.col("_following").isNull() | (F.col("_following") != F.col("_next"))
    present = marked.groupBy(out).agg(
        F.count_if(F.col("_nth") == 1).alias("new_users"),
        F.count(F.lit(1)).alias("active_users"),
    )
    churned = marked.where(leaves).groupBy(F.col("_next").alias(out)).agg(
        F.count(F.lit(1)).alias("churned_users")
    )
    zero = F.lit(0).cast("bigint")
    joined = present.join(churned, out, "full").select(
        out,
        *[F.coalesce(c, zero).alias(c) for c in ("new_users", "active_users", "churned_users")],
    )
    # The period after the last one has not been observed yet.
    last = pairs.agg(F.max(out)).scalar()
    return joined.where(F.col(out) <= last).withColumn(
        "net_new_users", F.col("new_users") - F.col("churned_users")
    )


def active_users(
    events: DataFrame, user: str, period: Column, out: str, period_col: str = "period"
) -> DataFrame:
    """Distinct users per period (daily, monthly, ...)."""
    return events.groupBy(period.alias(period_col)).agg(F.countDistinct(user).alias(out))


def spikes(
    series: DataFrame,
    keys: Sequence[str],
    day: str,
    metric: str,
    limit: float = 0.3,
) -> DataFrame:
    """Days whose metric moved by more than ``limit`` from the day before.

    ``series`` holds one row per key and day. The day before is found by an equi-join on the
    date, not by a window over the whole series.
    """
    before = series.select(
        *keys, F.date_add(day, 1).alias(day), F.col(metric).alias(f"previous_{metric}")
    )
    moved = series.select(*keys, day, metric).join(before, [*keys, day])
    change = ratio(F.col(metric) - F.col(f"previous_{metric}"), F.col(f"previous_{metric}"))
    return moved.withColumn("change", change).where(F.abs("change") > limit)


def key_violations(df: DataFrame, keys: Sequence[str], out: str = "row_count") -> DataFrame:
    """Keys that break uniqueness or hold a NULL, standing in for a primary key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return counts.where((F.col(out) > 1) | missing)


def field_report(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Failures per rule, one row per rule with rows checked; one pass over the data.

    A rule is a condition that must be true; NULL counts as a failure.
    """
    counts = [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"_{i}")
        for i, rule in enumerate(rules.values())
    ]
    lines = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("failures"))
            for i, name in enumerate(rules)
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("rows_checked"), *counts).select(
        F.inline(lines), "rows_checked"
    )


def schema_drift(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str, str, str]]:
    """Columns that were added, removed or changed type: (column, status, expected, actual)."""
    old = {f.name: f.dataType.simpleString() for f in expected}
    new = {f.name: f.dataType.simpleString() for f in actual}
    lines = []
    for name in dict.fromkeys([*old, *new]):
        if name not in new:
            lines.append((name, "removed", old[name], ""))
        elif name not in old:
            lines.append((name, "added", "", new[name]))
        elif old[name] != new[name]:
            lines.append((name, "type changed", old[name], new[name]))
    return lines
