"""Match facts with their dimensions, and the metrics over them.

Every metric is computed at the grain of its own fact table. Joining player rows with medal
rows of the same match first would repeat each player row once per medal row (all pairs
within a match), which both inflates the sums and explodes on a large match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.conditions import ratio

def prefixed(dim: DataFrame, prefix: str, key: str) -> DataFrame:
    """Dimension columns renamed with a prefix, except the key."""
    return dim.withColumnsRenamed({c: f"{prefix}_{c}" for c in dim.columns if c != key})


def enrich(facts: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Facts joined with dimensions given as ``(frame, key, prefix)``.

    Each dimension has one row per key and joins on that key. There is no hint: Spark
    broadcasts a dimension if its bytes, known or measured at run time, are few enough, and
    else shuffles both sides and splits skewed partitions.
    """
    for dim, key, prefix in dims:
        facts = facts.join(prefixed(dim, prefix, key), key)
    return facts


def salt_hot_keys(
    facts: DataFrame, lookup: DataFrame, key: str, max_rows: int, salt_col: str = "salt"
) -> tuple[DataFrame, DataFrame]:
    """Give both sides of a join a salt, so a key with many fact rows fills several buckets.

    Fact rows of a key with more than ``max_rows`` rows get one of ``n`` salts by a hash of
    the row, and the key's lookup rows are repeated for each of them; all other keys have
    the single salt 0. Joining on (key, salt) gives the same rows as joining on the key. The
    hash depends on the row alone, so a task that runs again gives the same salts; identical
    copies of a row share one, so deduplicate first where copies abound.
    """
    hot = (
        facts.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > max_rows)
        .select(key, F.ceil(F.col("_rows") / F.lit(max_rows)).alias("_salts"))
    )
    hashed = F.pmod(F.xxhash64(*facts.columns), F.col("_salts"))
    salted_facts = facts.join(hot, key, "left").withColumn(
        salt_col, F.coalesce(hashed, F.lit(0).cast("bigint"))
    )
    salts = F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_lookup = lookup.join(hot, key, "left").withColumn(
        salt_col, F.explode(salts)
    )
    return salted_facts.drop("_salts"), salted_lookup.drop("_salts")


def average_per_match(
    details: DataFrame, player: str, match: str, value: str, out: str
) -> DataFrame:
    """Total, number of matches and average per match of every player."""
    return (
        details.groupBy(player)
        .agg(
            F.sum(value).alias(f"total_{value}"), F.countDistinct(match).alias("games_played")
        )
        .withColumn(out, ratio(F.col(f"total_{value}"), F.col("games_played")))
    )


def played_matches(matches: DataFrame, facts: DataFrame, match: str) -> DataFrame:
    """Matches with at least one fact row; facts are reduced to distinct matches first."""
    return matches.join(facts.select(match).distinct(), match, "left_semi")


def count_matches(matches: DataFrame, by: str, match: str, out: str) -> DataFrame:
    """Distinct matches per value of ``by``."""
    return matches.groupBy(by).agg(F.countDistinct(match).alias(out))


def medal_total(
    medal_counts: DataFrame,
    matches: DataFrame,
    medals: DataFrame,
    condition: Column,
    match: str,
    medal: str,
    by: str,
    count_col: str,
    out: str,
) -> DataFrame:
    """Sum of the counts of the chosen medals per value of ``by`` (a column of matches)."""
    chosen = medals.where(condition).select(medal)
    per_match = (
        medal_counts.join(chosen, medal, "left_semi")
        .groupBy(match)
        .agg(F.sum(count_col).alias("_count"))
    )
    return (
        per_match.join(matches.select(match, by), match)
        .groupBy(by)
        .agg(F.sum("_count").alias(out))
    )
