"""Quality by hierarchical empirical Bayes over documents, hosts and paths."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gram_model import FIT_ROWS, fit, labelled, with_odds
from .store import written

#: Bounds of a prior's weight in documents.
LIGHT, HEAVY = 1.0, 100_000.0


def prior_weight(groups: DataFrame, mean: Column | float) -> DataFrame:
    """One row, ``weight``: how many documents the prior of a group's rate is worth.

    Method of moments on groups (n, s): the spread of the rates beyond what groups of these
    sizes show by chance gives the variance of the true rates, and from it the weight of the
    beta prior around ``mean`` (a column of ``groups`` or one number).
    """
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    gap = F.col("n") * (F.col("s") / F.col("n") - mean) ** 2
    chance = mean * (1 - mean)
    sums = groups.where("n > 0").agg(
        F.sum(gap).alias("gap"), F.sum(chance).alias("chance"), F.sum("n").alias("n"),
        F.count("*").alias("g"), F.avg(chance).alias("level"),
    )
    variance = (F.col("gap") - F.col("chance")) / (F.col("n") - F.col("g") + 1)
    weight = F.when(variance > 0, F.col("level") / variance - 1).otherwise(HEAVY)
    return sums.select(F.greatest(F.lit(LIGHT), F.least(F.lit(HEAVY), F.coalesce(weight, F.lit(HEAVY)))).alias("weight"))


def site_quality(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: tuple = ("source", "lang"), fit_rows: int = FIT_ROWS
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text and the site columns): doc_id, evidence, host_posterior,
    path_posterior, score, keep.

    ``evidence`` is the text classifier's probability of quality, trained on ``labels`` (doc_id,
    quality). The classifier's probabilities are summed per host and per path; a path's rate is
    shrunk toward its host's and a host's toward the global one, by weights estimated from the
    spread of the rates, so sites with few documents follow the level above them. The score is
    the evidence moved by the odds of the path's posterior against the global rate, ``keep`` is
    1 where it is 0.5 or more.

    Null and empty texts have the evidence of an empty text; long ones are scored whole. A null host or path is a site of
    its own. Unlabelled corpora get the constant evidence of ``gram_model.fit``. Repeated rows
    count and are returned as often as they come. Ties do not arise. An empty table gives an
    empty result. Other columns are ignored, also if they are named like those returned.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").alias("label"))
    model = fit(labelled(docs, known), fit_rows)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.to_json(F.struct(*[F.col(c).cast("string").alias(f"p{i}") for i, c in enumerate(path)])).alias("path"), "text",
    )
    odds = F.element_at("odds", 1)
    scored = with_odds(rows, [model], ("doc_id", "host", "path"))
    scored = written(scored.select("doc_id", "host", "path", odds.alias("odds"), (1 / (1 + F.exp(-odds))).alias("evidence")), "evidence")
    # Rows of a site are summed before the shuffle, so a site with a third of them is no burden.
    paths = scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s"))
    paths = written(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    count = total["n"] or 0
    rate = min(max((total["s"] or 0.0) / count, 1e-6), 1 - 1e-6) if count else 0.5
    heavy = prior_weight(hosts, rate).first()["weight"]
    hosts = hosts.select("host", ((F.col("s") + heavy * rate) / (F.col("n") + heavy)).alias("host_posterior"))
    inside = written(paths.join(hosts, "host"), "sites")
    heavy = prior_weight(inside, F.col("host_posterior")).first()["weight"]
    sites = inside.select(
        "host", "path", "host_posterior", ((F.col("s") + heavy * F.col("host_posterior")) / (F.col("n") + heavy)).alias("path_posterior")
    )
    level = F.least(F.greatest("path_posterior", F.lit(1e-6)), F.lit(1 - 1e-6))
    moved = F.col("odds") + F.log(level / (1 - level)) - math.log(rate / (1 - rate))
    score = 1 / (1 + F.exp(-moved))
    return scored.join(sites, ["host", "path"]).select(
        "doc_id", "evidence", "host_posterior", "path_posterior", score.alias("score"), (score >= 0.5).cast("int").alias("keep")
    )
