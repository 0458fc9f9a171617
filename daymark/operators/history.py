"""Entity history: per-period snapshots, type-2 dimensions and activity states."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.conditions import (
    NEW,
    QUALITY_FLOOR,
    QUALITY_THRESHOLDS,
    UNKNOWN,
    activity_state,
    classify,
)
from .hot import MAX_ROWS, running_sum

# Items in one row of a snapshot.
PART_ITEMS = 10_000


def quiet_periods(
    facts: DataFrame, key: Sequence[str], period: str, first: int, last: int
) -> DataFrame:
    """Entity and period for every period from ``first`` to ``last`` that has no facts,
    after the entity's first fact.

    The range condition is a generated sequence between one period with facts and the
    next, which needs no join. A window holds at most one row per period.
    """
    seen = (
        facts.where(F.col(period) <= last)
        .select(*key, F.greatest(F.col(period), F.lit(first - 1)).alias(period))
        .distinct()
    )
    following = F.lead(period, 1, last + 1).over(Window.partitionBy(*key).orderBy(period))
    return (
        seen.select(*key, (F.col(period) + 1).alias("_from"), (following - 1).alias("_to"))
        .where(F.col("_from") <= F.col("_to"))
        .select(*key, F.explode(F.sequence("_from", "_to")).alias(period))
    )


def lowest_id_per_name(facts: DataFrame, name: str, key: str) -> DataFrame:
    """Keep only the lowest id of every name, for sources that join by name."""
    lowest = facts.groupBy(F.col(name).alias("_name")).agg(F.min(key).alias("_id"))
    return facts.join(
        lowest, (F.col(name) == F.col("_name")) & (F.col(key) == F.col("_id")), "left_semi"
    )


def entity_period_status(
    facts: DataFrame,
    key: Sequence[str],
    period: str,
    order: str,
    rating: str,
    first: int,
    last: int,
    thresholds: Sequence[tuple[str, float]] = QUALITY_THRESHOLDS,
    floor: str = QUALITY_FLOOR,
    class_col: str = "quality_class",
    active_col: str = "is_active",
) -> DataFrame:
    """Class and active flag of every entity in every period since its first.

    The class comes from the rating of the period's last fact by ``order``. A period
    without facts gets the lowest class and ``is_active = false``. This is the snapshot
    without its items: plain aggregates, combined before the shuffle.
    """
    group = [*key, period]
    active = (
        facts.where(F.col(period).between(first, last))
        .groupBy(*group)
        .agg(F.max_by(rating, order).alias("_rating"))
        .select(
            *group,
            classify(F.col("_rating"), thresholds, floor).alias(class_col),
            F.lit(True).alias(active_col),
        )
    )
    quiet = quiet_periods(facts, key, period, first, last).select(
        *group, F.lit(floor).alias(class_col), F.lit(False).alias(active_col)
    )
    return active.unionByName(quiet)


def entity_period_snapshot(
    facts: DataFrame,
    key: Sequence[str],
    period: str,
    item: Sequence[str],
    item_order: str,
    rating: str,
    first: int,
    last: int,
    thresholds: Sequence[tuple[str, float]] = QUALITY_THRESHOLDS,
    floor: str = QUALITY_FLOOR,
    items_col: str = "items",
    class_col: str = "quality_class",
    active_col: str = "is_active",
    part_items: int = PART_ITEMS,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Items, class and active flag of every entity in every period since its first.

    The items are ordered by ``item_order`` (a number, date or timestamp, present and
    unique within an entity and period), and the rating of the last one gives the class. A
    period without items gets an empty array, the lowest class and ``is_active = false``.

    Every group is cut alike: each ``part_items`` items in their order make a row, and
    ``part`` counts these rows 0, 1, 2, ... within the entity and period. All of them carry
    the same class and flag. The place of an item is an exact running count, which is spread
    over cells where one group holds more than ``max_rows`` items.
    """
    group = [*key, period]
    inside = facts.where(F.col(period).between(first, last)).withColumn("_one", F.lit(1))
    placed = running_sum(inside, group, [item_order], "_one", "_place", max_rows)
    entry = F.struct(F.col(item_order).alias("_order"), F.struct(*item).alias("_item"))
    last_rating = F.struct(F.col(item_order).alias("_order"), F.col(rating).alias("_rating"))
    part = F.floor((F.col("_place") - 1) / F.lit(part_items)).cast("bigint")
    active = (
        placed.groupBy(*group, part.alias("part"))
        .agg(F.sort_array(F.collect_list(entry)).alias("_items"), F.max(last_rating).alias("_last"))
        .withColumn("_last", F.max("_last").over(Window.partitionBy(*group)))
        .select(
            *group,
            "part",
            F.transform("_items", lambda e: e["_item"]).alias(items_col),
            classify(F.col("_last._rating"), thresholds, floor).alias(class_col),
            F.lit(True).alias(active_col),
        )
    )
    quiet = quiet_periods(facts, key, period, first, last).select(
        *group,
        F.lit(0).cast("bigint").alias("part"),
        F.array().cast(active.schema[items_col].dataType).alias(items_col),
        F.lit(floor).alias(class_col),
        F.lit(False).alias(active_col),
    )
    return active.unionByName(quiet)


def accumulate_items(
    snapshot: DataFrame, key: Sequence[str], period: str, items_col: str = "items"
) -> DataFrame:
    """Key, period and all items up to that period, in the order of periods and parts.

    One row per entity and period, whatever the parts of the snapshot. The result repeats
    earlier items in every later period by definition, so it is meant for entities whose
    items fit in a row.
    """
    entry = F.struct(F.col("part").alias("_part"), F.col(items_col).alias("_items"))
    whole = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["_items"])
    so_far = (
        Window.partitionBy(*key).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    )
    periods = snapshot.groupBy(*key, period).agg(F.flatten(whole).alias(items_col))
    return periods.withColumn(items_col, F.flatten(F.collect_list(items_col).over(so_far)))


def scd2_backfill(
    df: DataFrame,
    key: Sequence[str],
    period: str,
    tracked: Sequence[str],
    as_of: int,
    start_col: str = "start_date",
    end_col: str = "end_date",
    gaps: str = "break",
) -> DataFrame:
    """Type-2 history up to ``as_of``: one row per stretch of unchanged tracked values.

    A period without a row ends a stretch, as it does in the increment; ``gaps="bridge"``
    looks at the previous row only, whatever the gap, and so claims the missing periods.

    The input holds one row per key and period, so a key's window has at most one row per
    period, and the grouping reuses the window's partitioning (one shuffle).
    """
    by_period = Window.partitionBy(*key).orderBy(period)
    first_row = F.row_number().over(by_period) == 1
    same = [F.col(c).eqNullSafe(F.lag(c).over(by_period)) for c in tracked]
    if gaps not in ("break", "bridge"):
        raise ValueError("gaps must be 'break' or 'bridge'")
    if gaps == "break":
        same.append(F.col(period) == F.lag(period).over(by_period) + 1)
    changed = F.when(first_row | reduce(lambda a, b: a & b, same), 0).otherwise(1)
    streak = F.sum("_changed").over(by_period.rowsBetween(Window.unboundedPreceding, 0))
    return (
        df.where(F.col(period) <= as_of)
        .select(*key, period, *tracked)
        .withColumn("_changed", changed)
        .withColumn("_streak", streak)
        .groupBy(*key, "_streak", *tracked)
        .agg(F.min(period).alias(start_col), F.max(period).alias(end_col))
        .select(*key, *tracked, start_col, end_col, F.lit(as_of).alias(period))
    )


def _with_history(
    history: DataFrame, current: DataFrame, key: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """History rows beside the current row of the same key, from one full outer join."""
    old = history.select(*key, F.struct(*values).alias("_old"))
    new = current.select(*key, F.struct(*values).alias("_new"))
    return old.join(new, list(key), "full")


def _as_values(
    current: DataFrame, tracked: Sequence[str], period: str, start_col: str, end_col: str
) -> DataFrame:
    return current.withColumn(start_col, F.col(period)).withColumn(end_col, F.col(period))


def scd2_increment(
    history: DataFrame,
    current: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    as_of: int,
    period: str,
    start_col: str = "start_date",
    end_col: str = "end_date",
) -> DataFrame:
    """Type-2 history as of ``as_of``, moved on by the rows of the next period.

    Closed rows (ended before ``as_of``) pass through without a shuffle. Open rows meet the
    current rows in one full outer join of unique keys: an unchanged row is extended, a
    changed one is closed and a new one opened, a new key is opened, and the open row of a
    key that has gone stays as it is.
    """
    values = [*tracked, start_col, end_col]
    history = history.where(F.col(period) == as_of).select(*key, *values)
    closed = history.where(F.col(end_col) < as_of)
    both = _with_history(
        history.where(F.col(end_col) == as_of),
        _as_values(current, tracked, period, start_col, end_col),
        key,
        values,
    )
    old, new = F.col("_old"), F.col("_new")
    same = reduce(lambda a, b: a & b, [old[c].eqNullSafe(new[c]) for c in tracked])
    extended = F.struct(
        *[old[c].alias(c) for c in tracked],
        old[start_col].alias(start_col),
        new[end_col].alias(end_col),
    )
    rows = (
        F.when(old.isNull(), F.array(new))
        .when(new.isNull(), F.array(old))
        .when(same, F.array(extended))
        .otherwise(F.array(old, new))
    )
    moved = both.select(*key, F.inline(rows))
    return closed.unionByName(moved.select(*key, *values)).withColumn(period, F.lit(as_of + 1))


def scd2_increment_as_written(
    history: DataFrame,
    current: DataFrame,
    key: Sequence[str],
    tracked: Sequence[str],
    as_of: int,
    period: str,
    start_col: str = "start_date",
    end_col: str = "end_date",
) -> DataFrame:
    """The increment in its original form, kept for users who depend on its rows.

    Every history row stays, open or not, and every history row of a key is also compared
    with the current row, so a key with several history rows yields repeated rows. Values
    are compared with plain equality: a NULL is neither equal nor different.
    """
    values = [*tracked, start_col, end_col]
    both = _with_history(
        history.where(F.col(period) == as_of),
        _as_values(current, tracked, period, start_col, end_col),
        key,
        values,
    )
    old, new = F.col("_old"), F.col("_new")
    same = reduce(lambda a, b: a & b, [old[c] == new[c] for c in tracked])
    differs = reduce(lambda a, b: a | b, [old[c] != new[c] for c in tracked])
    extended = F.struct(
        *[new[c].alias(c) for c in tracked],
        old[start_col].alias(start_col),
        new[end_col].alias(end_col),
    )
    rows = (
        F.when(old.isNull(), F.array(new))
        .when(same, F.array(old, extended))
        .when(differs, F.array(old, old, new))
        .otherwise(F.array(old))
    )
    return both.select(*key, F.inline(rows)).select(*key, *values)


def changed_records(
    history: DataFrame, current: DataFrame, key: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """Current rows whose tracked values differ from a history row of the same key."""
    old = history.select(*key, *[F.col(c).alias(f"_old_{c}") for c in tracked])
    differs = reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in tracked]
    )
    return current.join(old, list(key)).where(differs).select(current.columns).distinct()


def new_records(history: DataFrame, current: DataFrame, key: Sequence[str]) -> DataFrame:
    """Current rows whose key has no history."""
    return current.join(history.select(*key).distinct(), list(key), "left_anti")


def state_change_pair(
    previous: DataFrame, current: DataFrame, key: Sequence[str], active: str, period: str
) -> DataFrame:
    """State label from two adjacent periods, one row per key of either.

    A key without a row in the previous period is new, active or not; one that has no row
    in the current period is unknown and gets the period after its last.
    """
    old = previous.select(
        *key, F.col(active).alias("was_active"), F.col(period).alias("previous_period")
    ).withColumn("_old", F.lit(True))
    new = current.select(
        *key, F.col(active).alias("is_active_now"), F.col(period).alias("_period")
    )
    label = F.when(F.col("_old").isNull(), F.lit(NEW)).otherwise(
        F.coalesce(activity_state(F.col("was_active"), F.col("is_active_now")), F.lit(UNKNOWN))
    )
    return new.join(old, list(key), "full").select(
        *key,
        F.coalesce(F.col("_period"), F.col("previous_period") + 1).alias(period),
        label.alias("state_change"),
        "was_active",
        "is_active_now",
        "previous_period",
    )


def state_change_history(
    df: DataFrame, key: Sequence[str], period: str, active: str
) -> DataFrame:
    """State label of every period from the row before it, whatever the gap.

    A first row is new if active and has no label otherwise. A key has one row per period,
    which bounds its window.
    """
    by_period = Window.partitionBy(*key).orderBy(period)
    was, now = F.col("was_active"), F.col("is_active_now")
    label: Column = F.when(was.isNull() & now, F.lit(NEW)).otherwise(activity_state(was, now))
    return (
        df.select(*key, period, F.col(active).alias("is_active_now"))
        .withColumn("was_active", F.lag("is_active_now").over(by_period))
        .withColumn("previous_period", F.lag(period).over(by_period))
        .select(
            *key,
            period,
            label.alias("state_change"),
            "was_active",
            "is_active_now",
            "previous_period",
        )
    )
