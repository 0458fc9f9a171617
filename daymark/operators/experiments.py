"""Experiment metrics: conversion, early activity, retention, cells and their comparison."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.conditions import ratio
from ..functions.dates import add_interval
from .hot import MAX_ROWS, chained_times, next_time


def conversions(
    events: DataFrame,
    key: str,
    ts: str,
    start: Column,
    goal: Column,
    within: dt.timedelta,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Every start event with the time of the first goal event within the given time.

    The first goal at or after each start is found in one ordered pass, so a key with many
    starts and goals does not produce all their pairs.
    """
    marked = (
        events.where(start | goal)
        .select(key, F.col(ts).alias("started_at"), start.alias("_start"), goal.alias("_goal"))
    )
    found = next_time(marked, [key], "started_at", "_goal", "_reached", max_rows)
    in_time = F.col("_reached") <= add_interval("started_at", within)
    return found.where("_start").select(
        key,
        "started_at",
        F.when(in_time, F.col("_reached")).alias("converted_at"),
        F.coalesce(in_time, F.lit(False)).alias("converted"),
    )


def funnel(
    events: DataFrame,
    key: str,
    ts: str,
    start: Column,
    steps: Mapping[str, tuple[Column, dt.timedelta]],
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Every start event with the times at which it went through ``steps``, in their order.

    ``steps`` maps names to a condition and the time allowed since the step before. Step ``x``
    is reached at the first event at or after the step before that meets its condition; its
    time is in ``x_at``, NULL if that is too late or there is none, as are all after it.
    """
    wanted = {f"_step{i}": condition for i, (condition, _) in enumerate(steps.values())}
    some = start
    for condition in wanted.values():
        some = some | condition
    marked = events.where(some).select(
        key, F.col(ts).alias("started_at"), start.alias("_start"), *[c.alias(n) for n, c in wanted.items()]
    )
    limits = [within for _, within in steps.values()]
    found = chained_times(marked, [key], "started_at", list(wanted), limits, "_times", max_rows)
    times = [F.col("_times")[i].alias(f"{name}_at") for i, name in enumerate(steps)]
    return found.where("_start").select(key, "started_at", *times)


def funnel_counts(started: DataFrame, steps: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Starts and how many of them reached each step, in all or per group."""
    reached = [F.count(f"{name}_at").alias(name) for name in steps]
    return started.groupBy(*by).agg(F.count(F.lit(1)).alias("starts"), *reached)


def conversion_rate(converted: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Starts, conversions and their share, in all or per group."""
    sums = converted.groupBy(*by).agg(
        F.count(F.lit(1)).alias("starts"), F.count_if("converted").alias("conversions")
    )
    return sums.withColumn("conversion_rate", ratio(F.col("conversions"), F.col("starts")))


def early_actions(
    events: DataFrame, key: str, ts: str, actions: Column, within: dt.timedelta
) -> DataFrame:
    """Chosen actions of every key within a time span after its first event.

    The join brings one start row to each key's events; a skewed side is split at run time.
    """
    start = events.groupBy(key).agg(F.min(ts).alias("first_seen"))
    taken = (
        events.where(actions)
        .select(key, ts)
        .join(start, key)
        .where(F.col(ts) < add_interval("first_seen", within))
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("actions"))
    )
    return start.join(taken, key, "left").select(
        key, "first_seen", F.coalesce("actions", F.lit(0).cast("bigint")).alias("actions")
    )


def weekly_retention(
    events: DataFrame, key: str, day: Column, weeks: int, cohort: Column
) -> DataFrame:
    """Per cohort: keys, and how many were active in the given week after their first day.

    Week ``n`` covers days ``7 * (n - 1)`` to ``7 * n - 1`` after the first day. ``cohort``
    is an expression over ``first_day``.
    """
    days = events.select(key, day.alias("_day")).distinct()
    first = days.groupBy(key).agg(F.min("_day").alias("first_day"))
    age = F.datediff("_day", "first_day")
    active = (
        days.join(first, key)
        .groupBy(key, "first_day")
        .agg(F.max(age.between(7 * (weeks - 1), 7 * weeks - 1)).alias("_retained"))
    )
    sums = active.groupBy(cohort.alias("cohort")).agg(
        F.count(F.lit(1)).alias("cohort_size"), F.count_if("_retained").alias("retained")
    )
    return sums.withColumn("retention_rate", ratio(F.col("retained"), F.col("cohort_size")))


def continued_share(messages: DataFrame, conversation: str, over: int) -> DataFrame:
    """Share of conversations with more than ``over`` messages."""
    sums = (
        messages.groupBy(conversation)
        .agg(F.count(F.lit(1)).alias("_messages"))
        .agg(
            F.count(F.lit(1)).alias("conversations"),
            F.count_if(F.col("_messages") > over).alias("continued"),
        )
    )
    return sums.withColumn("continued_share", ratio(F.col("continued"), F.col("conversations")))


def cell(
    unit: Column | str, salt: str, treatment_percent: int = 50, names=("control", "treatment")
) -> Column:
    """Cell of a unit by a salted MD5, the same on every run and engine.

    The first 32 bits of the digest decide; another salt gives an independent split.
    """
    unit = F.col(unit) if isinstance(unit, str) else unit
    digest = F.md5(F.concat(F.lit(f"{salt}:"), unit.cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.when(F.pmod(number, F.lit(100)) < treatment_percent, names[1]).otherwise(names[0])


def compare_cells(
    units: DataFrame, cell_col: str, success: Column, names=("control", "treatment")
) -> DataFrame:
    """One row: size, successes and rate per cell, lift, and the two-proportion z statistic."""
    control, treatment = names
    sums = units.agg(
        *[
            agg
            for name in names
            for agg in (
                F.count_if(F.col(cell_col) == name).alias(f"{name}_units"),
                F.count_if((F.col(cell_col) == name) & success).alias(f"{name}_successes"),
            )
        ]
    )

    def rate(name: str) -> Column:
        return ratio(F.col(f"{name}_successes"), F.col(f"{name}_units"))

    n_a, n_b = (F.col(f"{n}_units").cast("double") for n in names)
    pooled = ratio(
        F.col(f"{control}_successes") + F.col(f"{treatment}_successes"),
        F.col(f"{control}_units") + F.col(f"{treatment}_units"),
    )
    error = F.sqrt(
        pooled * (F.lit(1.0) - pooled) * (F.try_divide(F.lit(1.0), n_a) + F.try_divide(F.lit(1.0), n_b))
    )
    return (
        sums.withColumn("control_rate", rate(control))
        .withColumn("treatment_rate", rate(treatment))
        .withColumn("lift", F.col("treatment_rate") - F.col("control_rate"))
        .withColumn("z", F.try_divide(F.col("lift"), error))
    )


def moments(df: DataFrame, by: Sequence[Column | str], value: Column) -> DataFrame:
    """Count, mean and squared deviations (``n``, ``mean``, ``m2``) of ``value`` per group, to be
    stored and merged; NULL and NaN do not count."""
    known = F.when(~F.isnan(value.cast("double")), value.cast("double"))
    return df.groupBy(*by).agg(
        F.count(known).alias("n"),
        F.avg(known).alias("mean"),
        (F.var_pop(known) * F.count(known)).alias("m2"),
    )


def merge_moments(parts: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Moments of larger groups from those of parts, such as days.

    The parts' deviations from the common mean are added to those within the parts, so nothing
    large is taken from something large.
    """
    named = parts.where("n > 0").select(*by, "n", "mean", "m2")
    groups = [c for c in named.columns if c not in ("n", "mean", "m2")]
    whole = Window.partitionBy(*groups)
    common = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    return named.withColumn("_common", common).groupBy(*groups).agg(
        F.sum("n").alias("n"),
        F.first("_common").alias("mean"),
        F.sum(F.col("m2") + F.col("n") * (F.col("mean") - F.col("_common")) ** 2).alias("m2"),
    )


def compare_means(merged: DataFrame, cell_col: str, names=("control", "treatment")) -> DataFrame:
    """One row from the moments of two cells: sizes, means, sample variances, the difference,
    Welch's t statistic and its degrees of freedom.

    An empty cell has no mean, one with a single value no variance; what follows from a missing
    number is NULL, and so are t and its degrees of freedom if neither cell varies.
    """
    columns = []
    for name in names:
        mine = F.col(cell_col) == name
        columns += [
            F.coalesce(F.max(F.when(mine, F.col("n"))), F.lit(0).cast("bigint")).alias(f"{name}_n"),
            F.max(F.when(mine, F.col("mean"))).alias(f"{name}_mean"),
            F.max(F.when(mine, F.try_divide("m2", F.col("n") - 1))).alias(f"{name}_variance"),
        ]
    row = merged.agg(*columns)
    errors = [F.try_divide(F.col(f"{n}_variance"), F.col(f"{n}_n")) for n in names]
    error = errors[0] + errors[1]
    terms = [F.try_divide(e * e, F.col(f"{n}_n") - 1) for e, n in zip(errors, names, strict=True)]
    return row.withColumns(
        {
            "difference": F.col(f"{names[1]}_mean") - F.col(f"{names[0]}_mean"),
            "t": F.try_divide(F.col(f"{names[1]}_mean") - F.col(f"{names[0]}_mean"), F.sqrt(error)),
            "degrees": F.try_divide(error * error, terms[0] + terms[1]),
        }
    )
