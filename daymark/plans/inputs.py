"""The given tables in the shape each operator reads."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import day_of

# Parameters of the daily jobs: the as-of day and the day before it.
TODAY = dt.date(2024, 1, 30)
YESTERDAY = TODAY - dt.timedelta(days=1)

# Parameters of the yearly jobs: the first and last year, and the year of the backfill.
FIRST_YEAR = 1995
LAST_YEAR = 2001
BACKFILL_YEAR = LAST_YEAR - 1


# Schemas of the given tables that the queries read.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; a stated schema saves reading a file footer first."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def web_events(spark: SparkSession, folder: str) -> DataFrame:
    """Hits: the event type is the host, the user also stands for the device."""
    return table(spark, folder, "events").select(
        "user_id",
        F.col("user_id").alias("device_id"),
        F.col("user_id").cast("string").alias("ip"),
        F.col("event_type").alias("host"),
        "ts",
    )


def devices(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("device_id"), F.col("c_mktsegment").alias("browser_type")
    )


def credits(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly items per entity: the orders of a customer, rated by their price."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.year("o_orderdate").alias("order_year"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_totalprice").alias("price"),
    )


def games(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with at least two suppliers, as games between the lowest and the highest."""
    teams = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("game_id"))
        .agg(
            F.min("l_suppkey").alias("home_team_id"), F.max("l_suppkey").alias("visitor_team_id")
        )
        .where(F.col("home_team_id") < F.col("visitor_team_id"))
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.year("o_orderdate").alias("season"),
        day_of("o_orderdate").alias("game_date"),
        (F.col("o_orderstatus") == "F").cast("int").alias("home_team_wins"),
    )
    return teams.join(orders, "game_id")


def game_details(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as player rows of a game: the part is the player, the supplier the team."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_suppkey").alias("team_id"),
        F.col("l_partkey").alias("player_id"),
        F.col("l_quantity").cast("int").alias("pts"),
    )


def match_details(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as player rows of a match: the supplier is the player."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("match_id"),
        F.col("l_suppkey").alias("player_id"),
        F.col("l_quantity").cast("bigint").alias("kills"),
    )


def matches(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as matches: the priority is the playlist, the customer's nation the map."""
    places = table(spark, folder, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("map_id")
    )
    return (
        table(spark, folder, "orders")
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("match_id"),
            F.col("o_orderpriority").alias("playlist_id"),
            day_of("o_orderdate").alias("completion_date"),
            "map_id",
        )
    )


def maps(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("map_id"), F.col("n_name").alias("name")
    )


def medals(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("medal_id"), F.col("p_type").alias("name")
    )


def match_medals(spark: SparkSession, folder: str) -> DataFrame:
    """Medals per match: lines per order and part."""
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("match_id"), F.col("l_partkey").alias("medal_id"))
        .agg(F.count(F.lit(1)).alias("medal_count"))
    )
