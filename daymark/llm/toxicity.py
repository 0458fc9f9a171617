"""Toxicity: a character n-gram linear classifier scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .gram_model import FIT_ROWS, GramModel, fit, labelled, with_odds

#: One fold of this many is held out.
FOLDS = 5


def fold(doc_id="doc_id"):
    """crc32 of doc_id as text, modulo the number of folds; fold 0 is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> GramModel:
    """The model of ``labels`` (doc_id, toxic) without the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").alias("label")).where(fold() != 0)
    return fit(labelled(docs, known), fit_rows)


def toxicity(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, score, predicted.

    The score is the classifier's probability for the whole text; only the text enters it.
    Texts that are null or empty have no n-gram but those of the padding and get the score of
    an empty text; long ones are scored whole. A score of exactly 0.5 is predicted toxic. Labels that are null, or of unknown documents, are left out; a document
    labelled twice counts as toxic if one label says so. If the labels lack one of the two
    classes, all scores are the smoothed share of label 1. Repeated rows are returned as often
    as they come, a null doc_id is not held out. Empty tables give empty results. Other
    columns are ignored.
    """
    model = train(docs, labels, fit_rows)
    odds = F.element_at("odds", 1)
    score = 1 / (1 + F.exp(-odds))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_odds(rows, [model]).select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic, unchanged; see ``toxicity``.

    The decision is made on the whole text itself, at any length, so rows with equal or null
    doc_id are judged each for itself. Null and empty texts have the score of an empty text; a
    score of exactly 0.5 is toxic. An empty table stays empty.
    """
    import numpy as np
    import pyarrow as pa

    from .gram_model import odds, text_chunks
    from .store import tidy

    shared = docs.sparkSession.sparkContext.broadcast([train(docs, labels, fit_rows)])
    place = docs.columns.index("text")

    def kept(batches):
        for batch in batches:
            low = [odds(texts, shared.value)[:, 0] < 0 for _, texts in text_chunks(batch.column(place))]
            if low:
                yield batch.filter(pa.array(np.concatenate(low)))

    return docs.mapInArrow(tidy(kept), docs.schema)
