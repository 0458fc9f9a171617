"""Yearly customer history: snapshots, type-2 dimensions and activity states."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.arrays import last_item
from ..operators.history import (
    accumulate_items,
    changed_records,
    entity_period_snapshot,
    entity_period_status,
    lowest_id_per_name,
    new_records,
    scd2_backfill,
    scd2_increment,
    scd2_increment_as_written,
    state_change_history,
    state_change_pair,
)
from .inputs import BACKFILL_YEAR, FIRST_YEAR, LAST_YEAR, credits, table

KEY, PERIOD, TRACKED = ["customer_id"], "order_year", ["quality_class", "is_active"]

# Price classes of the last order of a year (about the quartiles of the prices).
PRICE_CLASSES = [("star", 374_000.0), ("good", 251_000.0), ("average", 125_000.0)]


def _yearly(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer and year, without the items."""
    return entity_period_status(
        credits(spark, folder),
        KEY,
        PERIOD,
        "order_id",
        "price",
        FIRST_YEAR,
        LAST_YEAR,
        thresholds=PRICE_CLASSES,
    )


def _year(spark: SparkSession, folder: str, year: int) -> DataFrame:
    return _yearly(spark, folder).where(F.col(PERIOD) == year)


def _history(spark: SparkSession, folder: str, year: int) -> DataFrame:
    return scd2_backfill(_yearly(spark, folder), KEY, PERIOD, TRACKED, year)


def entity_year_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, price class and active flag of every customer and year."""
    ids = F.transform("items", lambda i: i["order_id"].cast("string"))
    snapshot = entity_period_snapshot(
        credits(spark, folder),
        KEY,
        PERIOD,
        ["order_id", "price"],
        "order_id",
        "price",
        FIRST_YEAR,
        LAST_YEAR,
        thresholds=PRICE_CLASSES,
    )
    return (
        snapshot.withColumn("order_ids", F.concat_ws(",", ids))
        .withColumn("order_count", F.size("items").cast("bigint"))
        .drop("items")
    )


def last_order_of_year(spark: SparkSession, folder: str) -> DataFrame:
    """The last order of every customer in each year with orders: the last item of the last part."""
    snapshot = entity_period_snapshot(
        credits(spark, folder), KEY, PERIOD, ["order_id", "price"], "order_id", "price", FIRST_YEAR, LAST_YEAR,
        thresholds=PRICE_CLASSES,
    )
    last = F.max_by(last_item(F.col("items")), "part")
    return snapshot.where(F.size("items") > 0).groupBy(*KEY, PERIOD).agg(last["order_id"].alias("last_order_id"))


def items_accumulated(spark: SparkSession, folder: str) -> DataFrame:
    """All orders of a customer up to each year."""
    snapshot = entity_period_snapshot(
        credits(spark, folder),
        KEY,
        PERIOD,
        ["order_id", "price"],
        "order_id",
        "price",
        FIRST_YEAR,
        LAST_YEAR,
        thresholds=PRICE_CLASSES,
    )
    ids = F.transform("items", lambda i: i["order_id"].cast("string"))
    return accumulate_items(snapshot, KEY, PERIOD).select(
        *KEY, PERIOD, F.concat_ws(",", ids).alias("order_ids")
    )


def lowest_part_per_type(spark: SparkSession, folder: str) -> DataFrame:
    """The part with the lowest key of every part type."""
    parts = table(spark, folder, "part").select("p_type", "p_partkey")
    return lowest_id_per_name(parts, "p_type", "p_partkey")


def backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Type-2 history of class and flag up to the year before the last."""
    return _history(spark, folder, BACKFILL_YEAR)


def increment(spark: SparkSession, folder: str) -> DataFrame:
    """The backfilled history moved on by the last year."""
    return scd2_increment(
        _history(spark, folder, BACKFILL_YEAR),
        _year(spark, folder, LAST_YEAR),
        KEY,
        TRACKED,
        BACKFILL_YEAR,
        PERIOD,
    )


def increment_as_written(spark: SparkSession, folder: str) -> DataFrame:
    """The increment with its original repeated rows."""
    return scd2_increment_as_written(
        _history(spark, folder, BACKFILL_YEAR),
        _year(spark, folder, LAST_YEAR),
        KEY,
        TRACKED,
        BACKFILL_YEAR,
        PERIOD,
    )


def changed_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose class or flag changed in the last year."""
    open_rows = _history(spark, folder, BACKFILL_YEAR).where(F.col("end_date") == BACKFILL_YEAR)
    return changed_records(open_rows, _year(spark, folder, LAST_YEAR), KEY, TRACKED)


def new_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers of the last year without any history."""
    history = _history(spark, folder, BACKFILL_YEAR)
    return new_records(history, _year(spark, folder, LAST_YEAR), KEY)


def state_change_pairwise(spark: SparkSession, folder: str) -> DataFrame:
    """Activity state from the last two years, in customer order."""
    yearly = _yearly(spark, folder)
    return state_change_pair(
        yearly.where(F.col(PERIOD) == BACKFILL_YEAR),
        yearly.where(F.col(PERIOD) == LAST_YEAR),
        KEY,
        "is_active",
        PERIOD,
    ).orderBy(*KEY)


def state_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Activity state of every customer and year."""
    return state_change_history(_yearly(spark, folder), KEY, PERIOD, "is_active")


QUERIES = {
    "entity_year_snapshot": entity_year_snapshot,
    "entity_year_items_accumulated": items_accumulated,
    "last_order_of_year": last_order_of_year,
    "lowest_id_per_name": lowest_part_per_type,
    "scd2_backfill": backfill,
    "scd2_incremental": increment,
    "scd2_incremental_as_written": increment_as_written,
    "scd2_changed_keys": changed_customers,
    "scd2_new_keys": new_customers,
    "state_change_pairwise": state_change_pairwise,
    "state_change_history": state_changes,
}

_YEARLY = """
    years AS (
      SELECT customer_id, CAST(unnest(range(first_year, 2002)) AS INTEGER) AS order_year
      FROM (SELECT o_custkey AS customer_id, year(min(o_orderdate)) AS first_year
            FROM orders GROUP BY o_custkey)),
    ordered AS (
      SELECT o_custkey, year(o_orderdate) AS y, count(*) AS n,
             string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids,
             arg_max(o_totalprice, o_orderkey) AS price
      FROM orders GROUP BY o_custkey, year(o_orderdate)),
    yearly AS (
      SELECT customer_id, order_year, coalesce(n, 0) AS order_count, coalesce(ids, '') AS order_ids,
             CASE WHEN price > 374000 THEN 'star' WHEN price > 251000 THEN 'good'
                  WHEN price > 125000 THEN 'average' ELSE 'bad' END AS quality_class,
             n IS NOT NULL AS is_active
      FROM years LEFT JOIN ordered ON o_custkey = customer_id AND y = order_year)
"""

_STRETCHES = """
    {name} AS (
      SELECT customer_id, quality_class, is_active,
             min(order_year) AS start_date, max(order_year) AS end_date
      FROM (SELECT *, order_year - row_number() OVER (
                     PARTITION BY customer_id, quality_class, is_active ORDER BY order_year) AS stretch
            FROM yearly WHERE order_year <= {year})
      GROUP BY customer_id, quality_class, is_active, stretch)
"""


def _stretches(name: str, year: int) -> str:
    return _STRETCHES.format(name=name, year=year)


ORACLES = {
    "entity_year_snapshot": f"""
        WITH {_YEARLY}
        SELECT customer_id, order_year, CAST(0 AS BIGINT) AS part, order_ids, order_count,
               quality_class, is_active
        FROM yearly
    """,
    "entity_year_items_accumulated": f"""
        WITH {_YEARLY}
        SELECT customer_id, order_year,
               coalesce((SELECT string_agg(ids, ',' ORDER BY y) FROM ordered
                         WHERE o_custkey = customer_id AND y <= order_year), '') AS order_ids
        FROM yearly
    """,
    "last_order_of_year": """
        SELECT o_custkey AS customer_id, CAST(year(o_orderdate) AS INTEGER) AS order_year, max(o_orderkey) AS last_order_id
        FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 2001 GROUP BY ALL
    """,
    "lowest_id_per_name": "SELECT p_type, min(p_partkey) AS p_partkey FROM part GROUP BY p_type",
    "scd2_backfill": f"""
        WITH {_YEARLY}, {_stretches("h", 2000)}
        SELECT *, CAST(2000 AS INTEGER) AS order_year FROM h
    """,
    "scd2_incremental": f"""
        WITH {_YEARLY}, {_stretches("h", 2001)}
        SELECT *, CAST(2001 AS INTEGER) AS order_year FROM h
    """,
    "scd2_incremental_as_written": f"""
        WITH {_YEARLY}, {_stretches("h", 2000)},
        pairs AS (
          SELECT h.*, y.quality_class AS now_class, y.is_active AS now_active,
                 (h.quality_class, h.is_active) = (y.quality_class, y.is_active) AS same
          FROM h JOIN yearly y ON y.customer_id = h.customer_id AND y.order_year = 2001)
        SELECT customer_id, quality_class, is_active, start_date, end_date FROM h
        UNION ALL
        SELECT customer_id, quality_class, is_active, start_date,
               CASE WHEN same THEN 2001 ELSE end_date END FROM pairs
        UNION ALL
        SELECT customer_id, now_class, now_active, 2001, 2001 FROM pairs WHERE NOT same
        UNION ALL
        SELECT customer_id, quality_class, is_active, 2001, 2001 FROM yearly
        WHERE order_year = 2001 AND customer_id NOT IN (SELECT customer_id FROM h)
    """,
    "scd2_changed_keys": f"""
        WITH {_YEARLY}
        SELECT b.customer_id, b.order_year, b.quality_class, b.is_active
        FROM yearly a JOIN yearly b USING (customer_id)
        WHERE a.order_year = 2000 AND b.order_year = 2001
          AND (a.quality_class, a.is_active) <> (b.quality_class, b.is_active)
    """,
    "scd2_new_keys": f"""
        WITH {_YEARLY}
        SELECT customer_id, order_year, quality_class, is_active FROM yearly
        WHERE order_year = 2001
          AND customer_id NOT IN (SELECT customer_id FROM yearly WHERE order_year <= 2000)
    """,
    "state_change_pairwise": f"""
        WITH {_YEARLY},
        sides AS (
          SELECT customer_id,
                 max(order_year) FILTER (WHERE order_year = 2000) AS previous_period,
                 bool_or(is_active) FILTER (WHERE order_year = 2000) AS was_active,
                 bool_or(is_active) FILTER (WHERE order_year = 2001) AS is_active_now
          FROM yearly WHERE order_year IN (2000, 2001) GROUP BY customer_id)
        SELECT customer_id, CAST(2001 AS INTEGER) AS order_year,
               CASE WHEN previous_period IS NULL THEN 'New'
                    ELSE CASE (was_active, is_active_now)
                      WHEN (true, true) THEN 'Continued Playing'
                      WHEN (true, false) THEN 'Retired'
                      WHEN (false, true) THEN 'Returned From Retired'
                      WHEN (false, false) THEN 'Stayed Retired'
                      ELSE 'Unknown' END END AS state_change,
               was_active, is_active_now, previous_period
        FROM sides
    """,
    "state_change_history": f"""
        WITH {_YEARLY},
        steps AS (
          SELECT b.customer_id, b.order_year, a.is_active AS was_active,
                 b.is_active AS is_active_now, a.order_year AS previous_period
          FROM yearly b LEFT JOIN yearly a
            ON a.customer_id = b.customer_id AND a.order_year = b.order_year - 1)
        SELECT *,
               CASE (was_active, is_active_now)
                 WHEN (true, true) THEN 'Continued Playing'
                 WHEN (true, false) THEN 'Retired'
                 WHEN (false, true) THEN 'Returned From Retired'
                 WHEN (false, false) THEN 'Stayed Retired'
                 ELSE CASE WHEN was_active IS NULL AND is_active_now THEN 'New' END
               END AS state_change
        FROM steps
    """,
}
