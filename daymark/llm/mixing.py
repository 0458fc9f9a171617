"""Mixing by soft membership: document rates whose expected domain tokens match targets.

A classifier trained on the label table gives each document a posterior over the domains
``good``, ``poor`` and ``toxic``. Rates w >= 0 minimise the squared misses of the domains'
expected token totals plus a small pull of every rate toward one, by accelerated projected
gradient steps. The misses are weighted by the inverse of the posteriors' second moments, which
makes all directions of the problem equally steep and leaves few steps to take. A step needs
one sum per domain over all documents. The rate of a document
follows from its posterior and the sums of the steps so far, so no rate is ever stored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gram_model import FIT_ROWS, count_grams, fit, labelled, odds, sigmoid, text_chunks, with_odds
from .store import tidy, written
from .toxicity import fold

DOMAINS = ("good", "poor", "toxic")
#: The place in ``DOMAINS`` of a row of labels.
DOMAIN = "CASE WHEN toxic = 1 THEN 2 WHEN quality = 1 THEN 0 WHEN quality = 0 THEN 1 END"
#: Share of the mixture's tokens per domain.
TARGETS = {"good": 0.90, "poor": 0.09, "toxic": 0.01}
#: The mixture's tokens as a share of all tokens.
BUDGET = 0.9
#: Strength of the pull toward rate one.
PULL = 1e-3
ROUNDS, CLOSE = 40, 1e-3


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
    """Two models: toxic against all, and good against poor among the rest.

    The n-grams of all rows of ``labels`` (doc_id, quality, toxic) are counted, once for both;
    only the regressions see about ``fit_rows`` of them each.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.expr(DOMAIN).alias("label"))
    rows = written(labelled(docs, known), "labelled")
    counted = written(count_grams(rows, len(DOMAINS)), "grams")
    told = counted.select("bucket", F.expr("n0 + n1").alias("neg"), F.col("n2").alias("pos"))
    toxic = fit(rows.withColumn("label", (F.col("label") == 2).cast("int")), fit_rows, counted=told)
    told = counted.where("n0 + n1 > 2").select("bucket", F.col("n1").alias("neg"), F.col("n0").alias("pos"))
    good = fit(rows.where("label < 2").withColumn("label", (F.col("label") == 0).cast("int")), fit_rows, counted=told)
    return [toxic, good]


def held_out(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(domain, texts, expected, log_loss): posteriors against the labels of the held-out fold.

    The models are trained on the other folds. Per domain: its held-out texts, the sum of its
    posteriors over all held-out texts, and its texts' mean -ln(posterior).
    """
    fits = train(docs, labels.where(fold() != 0), fit_rows)
    known = labels.where(fold() == 0).select(F.col("doc_id").cast("long"), F.expr(DOMAIN).alias("label"))
    rows = written(labelled(docs, known), "held out")
    told = _posterior_table(rows, fits).select("doc_id", "p").join(rows.select("doc_id", "label"), "doc_id")
    each = told.select("label", F.posexplode("p").alias("k", "p"))
    sums = each.groupBy("k").agg(
        F.count_if(F.expr("label = k")).alias("texts"), F.sum("p").alias("expected"), F.avg(F.expr("CASE WHEN label = k THEN -ln(p) END")).alias("log_loss")
    )
    return sums.select(F.element_at(F.array(*map(F.lit, DOMAINS)), F.col("k") + 1).alias("domain"), "texts", "expected", "log_loss")


def posteriors(logits: np.ndarray) -> np.ndarray:
    """Probabilities of good, poor and toxic from the two models' log-odds."""
    toxic, good = sigmoid(logits[:, 0]), sigmoid(logits[:, 1])
    return np.stack([(1 - toxic) * good, (1 - toxic) * (1 - good), toxic], 1)


def rates(p: np.ndarray, steps: list[tuple], pull: float = PULL) -> tuple[np.ndarray, np.ndarray]:
    """(w, y) after the given steps: the rates, and the point at which the next misses are taken.

    A step is (weighted misses per domain, momentum).
    """
    w = y = np.ones(len(p))
    for misses, momentum in steps:
        new = np.maximum(0, y - (p @ np.asarray(misses) + pull * (y - 1)) / (1 + pull))
        w, y = new, new + momentum * (new - w)
    return w, y


def solve(table: DataFrame, targets: dict, budget: float, pull: float = PULL, rounds: int = ROUNDS) -> list[tuple]:
    """Steps of projected gradient descent over ``table`` (n_tokens, p array)."""
    pairs = [(i, j) for i in range(len(DOMAINS)) for j in range(len(DOMAINS))]
    moments = [F.sum(F.col("n_tokens") * F.element_at("p", i + 1) * F.element_at("p", j + 1)) for i, j in pairs]
    total, *moments = table.agg(F.sum("n_tokens"), *moments).first()
    if not total:
        return []
    weight = np.linalg.pinv(np.array(moments).reshape(len(DOMAINS), -1) / total, rcond=1e-6, hermitian=True)
    goal = np.array([targets.get(d, 0.0) for d in DOMAINS]) * budget
    steps, speed, before = [], 1.0, None

    def sums(point):
        def part(batches):
            out = np.zeros((2, len(DOMAINS)))
            for batch in batches:
                p = batch.column(1).flatten().to_numpy().reshape(-1, len(DOMAINS))
                t = batch.column(0).to_numpy()
                w, y = rates(p, point, pull)
                out += np.stack([(t * w) @ p, (t * y) @ p])
            yield pa.RecordBatch.from_arrays([pa.array([row.tolist()]) for row in out], ["w", "y"])

        one = table.select("n_tokens", "p").mapInArrow(part, "w array<double>, y array<double>")
        aggregates = [F.sum(F.element_at(c, i + 1)) for c in ("w", "y") for i in range(len(DOMAINS))]
        return np.array(one.agg(*aggregates).first()).reshape(2, -1) / total

    for _ in range(rounds):
        at_w, at_y = sums(list(steps)) - goal
        if np.abs(at_w).max() < CLOSE:
            break
        if before is not None and np.abs(at_w).sum() > before:
            speed = 1.0
        before = np.abs(at_w).sum()
        after = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        steps.append((tuple((weight @ at_y).tolist()), (speed - 1) / after))
        speed = after
    return steps


def _posterior_table(docs: DataFrame, models) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    toxic, good = (1 / (1 + F.exp(-F.element_at("odds", i))) for i in (1, 2))
    p = F.array((1 - toxic) * good, (1 - toxic) * (1 - good), toxic)
    return written(with_odds(rows, models, tokens=True).select("doc_id", "n_tokens", p.alias("p")), "posteriors")


def mixture_rates(
    docs: DataFrame, labels: DataFrame, targets: dict | None = None, budget: float = BUDGET, fit_rows: int = FIT_ROWS
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_tokens, p_good, p_poor, p_toxic, rate.

    Tokens are words separated by white space. With the rates as expected numbers of copies,
    the mixture has ``budget`` of all tokens, and of these the share ``targets`` names for each
    domain, as far as rates of at least zero allow. Null and empty texts have no tokens, a
    posterior like any other text, and a rate that follows from it. Texts are scored whole, at
    any length. Equal texts, and texts with equal posteriors, get equal rates. A domain without labels gets the smoothed constant posterior of ``gram_model.fit``.
    Repeated rows and null doc_id are returned as they come; an empty table gives an empty
    result. Other columns are ignored.
    """
    table = _posterior_table(docs, train(docs, labels, fit_rows))
    steps = solve(table, targets or TARGETS, budget)

    def rated(batches):
        for batch in batches:
            p = batch.column(2).flatten().to_numpy().reshape(-1, len(DOMAINS))
            w, _ = rates(p, steps)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(p[:, k].copy()) for k in range(len(DOMAINS))], pa.array(w)],
                ["doc_id", "n_tokens", *[f"p_{d}" for d in DOMAINS], "rate"],
            )

    columns = "doc_id long, n_tokens long, " + ", ".join(f"p_{d} double" for d in DOMAINS) + ", rate double"
    return table.mapInArrow(rated, columns)


def mixed(
    docs: DataFrame, labels: DataFrame, targets: dict | None = None, budget: float = BUDGET, fit_rows: int = FIT_ROWS
) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says; see ``mixture_rates``.

    The whole part of a rate is the number of copies; the rest is one more copy for the rows
    whose hash of doc_id and text falls below it. So a run can be repeated, and equal rows of
    one doc_id are decided alike. Texts are scored whole, at any length; null and empty ones have
    the posterior of an empty text. Rows keep all their columns; an empty table stays empty.
    """
    models = train(docs, labels, fit_rows)
    steps = solve(_posterior_table(docs, models), targets or TARGETS, budget)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    names = docs.columns
    place = names.index("text")
    chance = F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1_000_003)) / 1_000_003

    def dealt(batches):
        for batch in batches:
            parts = [odds(texts, shared.value) for _, texts in text_chunks(batch.column(place))]
            if parts:
                w, _ = rates(posteriors(np.concatenate(parts)), steps)
                draw = batch.column(batch.num_columns - 1).to_numpy()
                copies = np.floor(w) + (draw < w - np.floor(w))
                rows = pa.array(np.repeat(np.arange(len(w)), copies.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([c.take(rows) for c in batch.columns[:-1]], names)

    # The draw is the last column, whatever the others are called.
    return docs.select("*", chance.alias("mixing draw")).mapInArrow(tidy(dealt), docs.schema)
