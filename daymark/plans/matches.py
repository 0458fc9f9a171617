"""Match facts: joins with dimensions, leaders, bucketed tables and layouts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.analytics import top_k
from ..operators.matches import (
    average_per_match,
    count_matches,
    enrich,
    medal_total,
    played_matches,
    salt_hot_keys,
)
from ..session import new_path
from ..sources.layout import layout_report
from ..sources.writers import bucket_write
from .inputs import maps, match_details, match_medals, matches, medals

# Parameters: the medal of the medal report, buckets per table, rows one bucket key may hold.
MEDAL = "PROMO"
BUCKETS = 16
BUCKET_ROWS = 10_000_000
#: Files of each sort layout.
LAYOUT_FILES = 8


def match_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """Player rows with their match and map."""
    facts = match_details(spark, folder).join(matches(spark, folder), "match_id")
    return enrich(facts, [(maps(spark, folder), "map_id", "map")])


def medals_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """Medal rows with their match, map and medal."""
    facts = match_medals(spark, folder).join(matches(spark, folder), "match_id")
    dims = [(maps(spark, folder), "map_id", "map"), (medals(spark, folder), "medal_id", "medal")]
    return enrich(facts, dims)


def _played(spark: SparkSession, folder: str) -> DataFrame:
    return played_matches(matches(spark, folder), match_details(spark, folder), "match_id")


def top_avg_kills(spark: SparkSession, folder: str) -> DataFrame:
    """The player with most kills per match."""
    known = match_details(spark, folder).join(
        matches(spark, folder).select("match_id"), "match_id", "left_semi"
    )
    players = average_per_match(known, "player_id", "match_id", "kills", "avg_kills_per_game")
    return top_k(players, "avg_kills_per_game", 1, ["player_id"])


def top_playlist(spark: SparkSession, folder: str) -> DataFrame:
    """The playlist with most matches."""
    counts = count_matches(_played(spark, folder), "playlist_id", "match_id", "num_games")
    return top_k(counts, "num_games", 1, ["playlist_id"])


def top_map(spark: SparkSession, folder: str) -> DataFrame:
    """The map with most matches."""
    counts = count_matches(_played(spark, folder), "map_id", "match_id", "num_games")
    return top_k(counts, "num_games", 1, ["map_id"])


def top_medal_map(spark: SparkSession, folder: str) -> DataFrame:
    """The map on which one medal was won most often."""
    totals = medal_total(
        match_medals(spark, folder),
        matches(spark, folder),
        medals(spark, folder),
        F.col("name") == MEDAL,
        "match_id",
        "medal_id",
        "map_id",
        "medal_count",
        "medals_won",
    )
    return top_k(totals, "medals_won", 1, ["map_id"])


def bucketed_join(spark: SparkSession, folder: str) -> DataFrame:
    """Kills per playlist, over fact tables bucketed alike so that they join in place.

    Both tables are written to the shared folder, bucketed by match and salt.
    """
    facts, lookup = salt_hot_keys(
        match_details(spark, folder),
        matches(spark, folder).select("match_id", "playlist_id"),
        "match_id",
        BUCKET_ROWS,
    )
    names = {}
    for name, df in (("details", facts), ("matches", lookup)):
        names[name] = f"match_{name}_{uuid.uuid4().hex}"
        path = new_path(spark, f"bucketed-{name}")
        bucket_write(df, names[name], ["match_id", "salt"], BUCKETS, path)
    joined = spark.table(names["details"]).join(
        spark.table(names["matches"]), ["match_id", "salt"]
    )
    return joined.groupBy("playlist_id").agg(
        F.sum("kills").alias("total_kills"), F.count(F.lit(1)).alias("player_rows")
    )


def layouts(spark: SparkSession, folder: str) -> DataFrame:
    """The enriched facts in three sort orders: rows and files.

    The bytes, which the operator reports as well, depend on the codec and not on the data alone.
    """
    columns = ["playlist_id", "map_id", "player_id"]
    return layout_report(match_enriched(spark, folder), columns, LAYOUT_FILES).drop("size_bytes")


QUERIES = {
    "match_enriched": match_enriched,
    "medals_enriched": medals_enriched,
    "top_avg_kills": top_avg_kills,
    "top_playlist": top_playlist,
    "top_map": top_map,
    "top_medal_map": top_medal_map,
    "bucketed_join": bucketed_join,
    "layout_report": layouts,
}

_MATCHES = """
    matches AS (
      SELECT o_orderkey AS match_id, o_orderpriority AS playlist_id,
             CAST(o_orderdate AS DATE) AS completion_date, c_nationkey AS map_id
      FROM orders JOIN customer ON c_custkey = o_custkey),
    played AS (SELECT * FROM matches WHERE match_id IN (SELECT l_orderkey FROM lineitem))
"""

ORACLES = {
    "match_enriched": f"""
        WITH {_MATCHES}
        SELECT map_id, match_id, l_suppkey AS player_id, CAST(l_quantity AS BIGINT) AS kills,
               playlist_id, completion_date, n_name AS map_name
        FROM lineitem JOIN matches ON match_id = l_orderkey JOIN nation ON n_nationkey = map_id
    """,
    "medals_enriched": f"""
        WITH {_MATCHES}
        SELECT p_partkey AS medal_id, map_id, match_id, count(*) AS medal_count, playlist_id,
               completion_date, n_name AS map_name, p_type AS medal_name
        FROM lineitem JOIN matches ON match_id = l_orderkey
        JOIN nation ON n_nationkey = map_id JOIN part ON p_partkey = l_partkey
        GROUP BY ALL
    """,
    "top_avg_kills": """
        SELECT l_suppkey AS player_id, CAST(sum(l_quantity) AS BIGINT) AS total_kills,
               count(DISTINCT l_orderkey) AS games_played,
               sum(l_quantity) / count(DISTINCT l_orderkey) AS avg_kills_per_game
        FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
        GROUP BY l_suppkey ORDER BY avg_kills_per_game DESC NULLS LAST, player_id LIMIT 1
    """,
    "top_playlist": f"""
        WITH {_MATCHES}
        SELECT playlist_id, count(DISTINCT match_id) AS num_games FROM played
        GROUP BY playlist_id ORDER BY num_games DESC, playlist_id LIMIT 1
    """,
    "top_map": f"""
        WITH {_MATCHES}
        SELECT map_id, count(DISTINCT match_id) AS num_games FROM played
        GROUP BY map_id ORDER BY num_games DESC, map_id LIMIT 1
    """,
    "top_medal_map": f"""
        WITH {_MATCHES}
        SELECT map_id, count(*) AS medals_won
        FROM lineitem JOIN part ON p_partkey = l_partkey JOIN matches ON match_id = l_orderkey
        WHERE p_type = 'PROMO' GROUP BY map_id ORDER BY medals_won DESC, map_id LIMIT 1
    """,
    "layout_report": f"""
        WITH {_MATCHES}, facts AS (
          SELECT count(*) AS num_rows FROM lineitem JOIN matches ON match_id = l_orderkey
          JOIN nation ON n_nationkey = map_id)
        SELECT unnest(['sorted_by_playlist_id', 'sorted_by_map_id', 'sorted_by_player_id']) AS layout,
               num_rows, {LAYOUT_FILES} AS num_files
        FROM facts
    """,
    "bucketed_join": """
        SELECT o_orderpriority AS playlist_id, CAST(sum(l_quantity) AS BIGINT) AS total_kills,
               count(*) AS player_rows
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY o_orderpriority
    """,
}
