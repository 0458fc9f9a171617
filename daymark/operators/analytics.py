"""Deduplication, roll-ups with leaders, and windows over games."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .hot import MAX_ROWS, longest_run


def duplicate_report(df: DataFrame, keys: Sequence[str], out: str = "row_count") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row of every key by ``order``, which must tell the rows of a key apart.

    Catalyst turns the filter into a limit inside every task before the shuffle, so a key
    with very many copies is shuffled as one row per task.
    """
    by_order = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_place", F.row_number().over(by_order))
        .where(F.col("_place") == 1)
        .drop("_place")
    )


def rollup_level(
    df: DataFrame,
    level: str,
    columns: Sequence[str],
    sums: Mapping[str, str],
    distinct: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """One grouping set with its label.

    ``sums`` maps output columns to summed columns, ``distinct`` maps output columns to
    (counted column, condition).
    """
    counts = [
        F.countDistinct(F.when(condition, F.col(c))).alias(name)
        for name, (c, condition) in (distinct or {}).items()
    ]
    return (
        df.groupBy(*columns)
        .agg(*[F.sum(c).alias(name) for name, c in sums.items()], *counts)
        .withColumn("level", F.lit(level))
    )


def grouping_sets_rollup(
    df: DataFrame,
    sets: Mapping[str, Sequence[str]],
    sums: Mapping[str, str],
    distinct: Mapping[str, tuple[str, str, Column]] | None = None,
    derived: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Sums over several grouping sets in one frame, each row labelled with its level.

    ``sets`` maps labels to columns; columns outside a row's set are NULL. ``distinct`` maps
    output columns to (level, counted column, condition); the column is NULL on other
    levels. Levels with a distinct count are grouped on their own, because under GROUPING
    SETS every row would be copied for every set and once more for the distinct values;
    the rest share one GROUPING SETS aggregation. ``derived`` maps columns of the sets that
    follow from the others of every set that has them, such as the name of an id, to their
    expression; they are made from the sums, so that no hash map and no shuffle holds them.
    """
    distinct, derived = distinct or {}, derived or {}
    named, columns = sets, list(dict.fromkeys(c for cols in sets.values() for c in cols))
    sets = {level: [c for c in cols if c not in derived] for level, cols in sets.items()}
    own = {level for level, _, _ in distinct.values()}
    parts = []

    shared = {level: cols for level, cols in sets.items() if level not in own}
    if shared:
        used = list(dict.fromkeys(c for cols in shared.values() for c in cols))
        label = F.lit(None).cast("string")
        for level, cols in shared.items():
            member = F.lit(True)
            for c in used:
                member = member & (F.col(f"_out_{c}") == (0 if c in cols else 1))
            label = F.when(member, F.lit(level)).otherwise(label)
        parts.append(
            df.groupingSets([[F.col(c) for c in cols] for cols in shared.values()], *used)
            .agg(
                *[F.sum(c).alias(name) for name, c in sums.items()],
                *[F.grouping(c).alias(f"_out_{c}") for c in used],
            )
            .withColumn("level", label)
            .drop(*[f"_out_{c}" for c in used])
        )
    for level in sets:
        if level in own:
            counts = {n: (c, cond) for n, (lv, c, cond) in distinct.items() if lv == level}
            parts.append(rollup_level(df, level, sets[level], sums, counts))

    having = {c: [level for level in named if c in named[level]] for c in columns if c in derived}
    made = {c: F.when(F.col("level").isin(*levels), derived[c]) for c, levels in having.items()}
    kinds = {c: df.schema[c].dataType for c in columns if c not in derived} | {n: "bigint" for n in distinct}
    filled = []
    for part in parts:
        missing = {c: F.lit(None).cast(t) for c, t in kinds.items() if c not in part.columns}
        filled.append(
            part.withColumns(missing).withColumns(made).select("level", *columns, *sums, *distinct)
        )
    result = filled[0]
    for part in filled[1:]:
        result = result.unionByName(part)
    return result


def top_k(
    df: DataFrame, by: str, k: int, tie_break: Sequence[Column | str]
) -> DataFrame:
    """The ``k`` rows with the highest ``by``, NULLs last; ``tie_break`` settles ties.

    Spark keeps only ``k`` rows per task, without a full sort.
    """
    if not tie_break:
        raise ValueError("top_k needs a tie break that makes the order total")
    return df.orderBy(F.col(by).desc_nulls_last(), *tie_break).limit(k)


def unpivot_sides(
    df: DataFrame, sides: Mapping[str, str], value: str, side: str, keep: Sequence[str]
) -> DataFrame:
    """One row per side of a game instead of one row with a column per side.

    ``sides`` maps a side's label to its column.
    """
    choices = F.array(
        *[F.struct(F.lit(n).alias(side), F.col(c).alias(value)) for n, c in sides.items()]
    )
    return df.select(*keep, F.inline(choices))


def team_results(
    games: DataFrame, game: Sequence[str], home: str, visitor: str, home_wins: str
) -> DataFrame:
    """Two rows per game, ``team_id`` and ``win`` (1 or 0)."""
    sides = unpivot_sides(
        games, {"home": home, "visitor": visitor}, "team_id", "_side", [*game, home_wins]
    )
    won = F.col(home_wins) == F.when(F.col("_side") == "home", 1).otherwise(0)
    return sides.select(*game, "team_id", F.when(won, 1).otherwise(0).alias("win"))


def longest_streak(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    value: str,
    over: float,
    out: str = "longest_streak",
    nulls: str = "break",
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Longest run of rows with ``value > over``, for all keys at once.

    ``order`` must be a total order within a key; its columns may be of any type that can be
    ordered. A row without a value breaks the run, or is passed over with ``nulls="skip"``.
    """
    if nulls not in ("break", "skip"):
        raise ValueError("nulls must be 'break' or 'skip'")
    if nulls == "skip":
        df = df.where(F.col(value).isNotNull())
    marked = df.select(*key, *order, (F.col(value) > F.lit(over)).alias("_over"))
    return longest_run(marked, key, order, "_over", out, max_rows)
