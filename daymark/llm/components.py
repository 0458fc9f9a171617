"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u long, v long); root is its least node.

    Each round hangs the larger neighbours of a node on its least neighbour, then the smaller
    ones, until every node hangs on its root. A node's neighbours are never gathered: the
    least comes from an aggregate that is combined before the shuffle, and goes back by a join
    that adaptive execution may split. Each round's table is written to the shared folder.
    """
    links = written(links.where("u <> v").select("u", "v").distinct(), "links")
    before = None
    while (state := _state(links)) != before:
        before = state
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        hung = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = hung.distinct()
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        inner = hung.join(least, "u")
        links = written(
            inner.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct(),
            "links",
        )
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(links.select("v", "v")).distinct()
