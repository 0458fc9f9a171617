"""Tables in versions as queries: deletes and upserts by file, and write, check, publish."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.analytics import duplicate_report
from ..session import new_path
from ..sources.versions import Published, delete_from, publish, read_rejects, read_version, upsert_into
from .inputs import table

LINE = ["l_orderkey", "l_linenumber"]


def versioned_delete(spark: SparkSession, folder: str) -> DataFrame:
    """Lines stored in order of their key, less all lines with a repeated line number."""
    path, lines = new_path(spark, "lines"), table(spark, folder, "lineitem")
    upsert_into(spark, path, lines.repartitionByRange("l_orderkey"), LINE)
    delete_from(spark, path, duplicate_report(lines, LINE), LINE)
    return read_version(spark, path)


def versioned_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Orders: the finished ones as a first version, then all others and the changed prices."""
    path = new_path(spark, "orders")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + F.when(urgent, 1).otherwise(0))
    upsert_into(spark, path, orders.where("o_orderstatus = 'F'").repartitionByRange("o_orderkey"), ["o_orderkey"])
    upsert_into(spark, path, changed.where((F.col("o_orderstatus") != "F") | urgent), ["o_orderkey"])
    return read_version(spark, path)


def _line(spark: SparkSession, path: str, name: str, run: Published) -> DataFrame:
    """What a run published and rejected by rule, and what readers see after it."""
    rules = read_rejects(spark, path, run.run).select(F.explode("rules").alias("rule"))
    counts = rules.groupBy("rule").agg(F.count(F.lit(1)).alias("rejected"))
    return counts.select(
        F.lit(name).alias("run"),
        F.lit(run.version is not None).alias("published"),
        F.lit(run.accepted).cast("long").alias("accepted"),
        "rule",
        "rejected",
        F.lit(read_version(spark, path).count()).cast("long").alias("visible"),
    )


def audited_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines by three runs: returned ones published although some rows are rejected, all of them
    refused by a stricter limit, and the others then added. After each run, what readers see."""
    path, lines = new_path(spark, "audited"), table(spark, folder, "lineitem")
    rules = {"quantity up to 45": F.col("l_quantity") <= 45, "discount under 9 %": F.col("l_discount") < 0.09}
    returned = F.col("l_returnflag") == "R"
    reports = []
    for name, rows, limit, append in (
        ("returned", lines.where(returned), 1.0, False),
        ("all", lines, 0.01, False),
        ("others", lines.where(~returned), 1.0, True),
    ):
        run = publish(rows, path, rules, LINE, limit, append)
        reports.append(_line(spark, path, name, run))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


QUERIES = {
    "versioned_delete": versioned_delete,
    "versioned_upsert": versioned_upsert,
    "audited_lines": audited_lines,
}

ORACLES = {
    "versioned_delete": """
        SELECT * FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN (
          SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
    """,
    "versioned_upsert": """
        SELECT o_orderkey, o_orderstatus, o_orderpriority,
               CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM orders
    """,
    "audited_lines": """
        WITH runs AS (
          SELECT 'returned' AS run, true AS published, * FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL SELECT 'all', false, * FROM lineitem
          UNION ALL SELECT 'others', true, * FROM lineitem WHERE l_returnflag <> 'R'),
        marked AS (
          SELECT run, published, l_quantity > 45 AS q, l_discount >= 0.09 AS d,
                 count(*) OVER (PARTITION BY run, l_orderkey, l_linenumber) > 1 AS k
          FROM runs),
        good AS (
          SELECT run, any_value(published) AS published,
                 count(*) FILTER (WHERE published AND NOT (q OR d OR k)) AS accepted
          FROM marked GROUP BY run),
        rejects AS (
          SELECT run, 'quantity up to 45' AS rule, count(*) AS rejected FROM marked WHERE q GROUP BY run
          UNION ALL SELECT run, 'discount under 9 %', count(*) FROM marked WHERE d GROUP BY run
          UNION ALL SELECT run, 'key', count(*) FROM marked WHERE k GROUP BY run)
        SELECT run, published, accepted, rule, rejected,
               CASE WHEN run = 'others' THEN (SELECT sum(accepted)::BIGINT FROM good)
                    ELSE (SELECT accepted FROM good WHERE run = 'returned') END AS visible
        FROM rejects JOIN good USING (run)
    """,
}
