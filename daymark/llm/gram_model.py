"""Linear text classifiers over hashed character n-grams scaled by naive Bayes ratios.

A text has a feature for each distinct n-gram of its lower-case characters, hashed to a bucket.
From labelled rows come, per bucket, the numbers of positive and negative texts that hold it;
the logarithm of the ratio of their smoothed shares scales the feature. Logistic regression on
the scaled features gives the weights. Scoring adds up table entries, so a model is one array
of ``2**BITS`` numbers whatever the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .store import tidy

BITS = 20
SIZES = (4, 5)
#: Buckets with the most telling counts that get a weight.
FEATURES = 1 << 11
#: Labelled rows that the regression sees at most (on average; chosen by a hash of doc_id).
FIT_ROWS = 16_000
#: Labels up to this many rows may be sent to all executors; larger tables are shuffled.
BROADCAST_LABELS = 2_000_000
CHUNK = 1 << 14
#: Features of texts that a step of the regression multiplies at once.
ENTRIES = 1 << 17
#: Tasks whose arrays of counts are added up in one task; what they give is summed by bucket.
TOGETHER = 256


def text_chunks(texts: pa.Array, most: int = 1 << 19):
    """(first row, padded lower-case texts) of about ``most`` characters each; nulls are empty."""
    held, size, first = [], 0, 0
    for some in range(0, len(texts), 256):
        for i, text in enumerate(texts.slice(some, 256).to_pylist(), some):
            text = f" {(text or '').lower()} "
            if held and size + len(text) > most:
                yield first, held
                held, size, first = [], 0, i
            held.append(text)
            size += len(text)
    if held:
        yield first, held


def grams(texts: list[str], bits: int = BITS, sizes: tuple = SIZES):
    """(row, bucket) of every n-gram, one pair of arrays per size."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    row = np.repeat(np.arange(len(texts), dtype=np.uint32), [len(t) for t in texts])
    total = np.zeros(len(points), np.uint64)
    for k in range(max(sizes)):
        if k:
            total = total[:-1]
        if not len(total):
            return
        total = total + points[k:] * K.WORD_VALUES[k]
        if k + 1 in sizes:
            mixed = (total ^ (total >> np.uint64(29))) * K.WORD_VALUES[8 + k % 8]
            bucket = (mixed >> np.uint64(64 - bits)).astype(np.uint32)
            whole = row[: len(total)] == row[k:]
            yield row[: len(total)][whole], bucket[whole]


def distinct(texts: list[str], bits: int = BITS, sizes: tuple = SIZES):
    """(row, bucket) pairs, each once, sorted by row.

    Every place of a text writes its number into its bucket's slot; the place whose number is
    found there afterwards stands for the bucket.
    """
    parts = [(bucket, np.searchsorted(row, np.arange(len(texts) + 1))) for row, bucket in grams(texts, bits, sizes)]
    longest = max((int((ends[1:] - ends[:-1]).max(initial=0)) for _, ends in parts), default=0)
    slot, places = np.empty(1 << bits, np.int32), np.arange(longest * len(parts), dtype=np.int32)
    kept = []
    for i in range(len(texts)):
        found = np.concatenate([bucket[ends[i] : ends[i + 1]] for bucket, ends in parts]) if parts else np.zeros(0, np.uint32)
        at = places[: len(found)]
        slot[found] = at
        kept.append(found[slot[found] == at])
    rows = np.repeat(np.arange(len(texts)), [len(k) for k in kept])
    return rows, np.concatenate(kept).astype(np.int64) if kept else np.zeros(0, np.int64)


@dataclass
class GramModel:
    """Weights per bucket and a constant; ``odds`` of a text is their sum."""

    table: np.ndarray
    bias: float
    bits: int = BITS
    sizes: tuple = SIZES


def odds(texts: list[str], models: list[GramModel]) -> np.ndarray:
    """Log-odds of each text under each model (rows x models)."""
    bits, sizes = models[0].bits, models[0].sizes
    some = np.zeros(1 << bits, bool)
    for m in models:
        some |= m.table != 0
    codes = []
    for row, bucket in grams(texts, bits, sizes):
        hit = np.flatnonzero(some[bucket])
        codes.append(row[hit].astype(np.uint64) << np.uint64(bits) | bucket[hit])
    code = np.unique(np.concatenate(codes)) if codes else np.zeros(0, np.uint64)
    row, bucket = (code >> np.uint64(bits)).astype(np.int64), code & np.uint64((1 << bits) - 1)
    return np.stack([m.bias + np.bincount(row, m.table[bucket], len(texts)) for m in models], 1)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _counts(batches, bits, classes):
    """Per task: how many texts of each class hold each bucket, in chunks of buckets."""
    counts = np.zeros((classes, 1 << bits), np.int32)
    for batch in batches:
        labels = batch.column(1).to_numpy(zero_copy_only=False)
        for first, texts in text_chunks(batch.column(0)):
            row, bucket = distinct(texts, bits)
            label = labels[first + row]
            for k in range(classes):
                counts[k] += np.bincount(bucket[label == k], minlength=1 << bits).astype(np.int32)
    size = min(CHUNK, 1 << bits)
    some = TaskContext.get().partitionId() // TOGETHER
    for c in range((1 << bits) // size):
        part = counts[:, c * size : (c + 1) * size]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([some], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["chunk", "some", "counts"])


def _chunk_sums(table: pa.Table, bits: int, classes: int) -> pa.Table:
    size = min(CHUNK, 1 << bits)
    total = np.zeros((classes, size), np.int64)
    for blob in table.column("counts").to_pylist():
        total += np.frombuffer(blob, np.int32).reshape(classes, size)
    some = np.flatnonzero(total.sum(0))
    chunk = table.column("chunk")[0].as_py()
    return pa.table({"bucket": some + chunk * size, **{f"n{k}": total[k][some] for k in range(classes)}})


def count_grams(rows: DataFrame, classes: int = 2, bits: int = BITS) -> DataFrame:
    """(bucket, n0, n1, ...): per bucket the texts of ``rows`` (text, label from 0) of each class.

    All rows are counted; buckets in fewer than three texts are left out.
    """
    sent = rows.select("text", F.col("label").cast("int")).mapInArrow(tidy(partial(_counts, bits=bits, classes=classes)), "chunk int, some int, counts binary")
    names = [f"n{k}" for k in range(classes)]
    schema = "bucket long, " + ", ".join(f"{n} long" for n in names)
    sums = sent.groupBy("chunk", "some").applyInArrow(lambda t: _chunk_sums(t, bits, classes), schema)
    return sums.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).where(" + ".join(names) + " > 2")


def _chosen(batches, index, bits):
    for batch in batches:
        for first, texts in text_chunks(batch.column(0)):
            row, bucket = distinct(texts, bits)
            at = index[bucket]
            row, at = row[at >= 0], at[at >= 0]
            bounds = np.searchsorted(row, np.arange(len(texts) + 1))
            yield pa.RecordBatch.from_arrays([K.long_lists(at, bounds), batch.column(1)[first : first + len(texts)]], ["features", "label"])


def logistic(rows, cols, values, labels, width, ridge=1e-4, rounds=300):
    """Weights and constant of ridge logistic regression; ``rows`` is sorted."""
    bounds = np.searchsorted(rows, np.arange(len(labels) + 1))
    return regression(bounds, cols, lambda i, j: values[i:j], labels, width, ridge, rounds)


def regression(bounds, cols, values, labels, width, ridge=1e-4, rounds=300):
    """Weights and constant of ridge logistic regression by accelerated gradient steps.

    Row k has the entries from ``bounds[k]`` to ``bounds[k + 1]``: their columns are in ``cols``,
    their values are given by ``values(first, last)``. A step takes ``ENTRIES`` of them at a
    time, and adds them up in the same order as one sum over all would. The step's length comes
    from the largest eigenvalue, found by power iteration.
    """
    n = len(labels)
    parts = [(i, min(i + ENTRIES, len(cols))) for i in range(0, len(cols), ENTRIES)]

    def forward(w):
        total, sum_so_far = np.zeros(n + 1), 0.0
        for i, j in parts:
            running = np.cumsum(np.concatenate([[sum_so_far], values(i, j) * w[cols[i:j]]]))
            some = slice(np.searchsorted(bounds, i), np.searchsorted(bounds, j, "right"))
            total[some] = running[bounds[some] - i]
            sum_so_far = running[-1]
        return total[1:] - total[:-1] + w[width]

    def backward(g):
        out = np.zeros(width + 1)
        for i, j in parts:
            first, last = np.searchsorted(bounds, i, "right") - 1, np.searchsorted(bounds, j)
            each = np.repeat(g[first:last], np.diff(np.clip(bounds[first : last + 1], i, j)))
            # The sums so far come first, so that every column is added up in order.
            out[:width] = np.bincount(
                np.concatenate([np.arange(width), cols[i:j]]), np.concatenate([out[:width], values(i, j) * each]), width
            )
        out[width] = g.sum()
        return out / n

    v = np.ones(width + 1) / np.sqrt(width + 1)
    top = 1.0
    for _ in range(12):
        v = backward(forward(v))
        top = np.linalg.norm(v) or 1.0
        v /= top
    step = 1 / (0.3 * top + ridge)
    w = np.zeros(width + 1)
    share = np.clip(labels.mean(), 1 / (n + 2), 1 - 1 / (n + 2))
    w[width] = np.log(share / (1 - share))
    ahead, momentum = w.copy(), 1.0
    for _ in range(rounds):
        slope = backward(sigmoid(forward(ahead)) - labels)
        slope[:width] += ridge * ahead[:width]
        new = ahead - step * slope
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = new + (momentum - 1) / after * (new - w)
        w, momentum = new, after
    return w[:width], w[width]


def _fitted(batches, ratios):
    lists, sizes, labels = [], [], []
    for batch in batches:
        lists.append(batch.column(0).flatten().to_numpy().astype(np.int32))
        sizes.append(np.diff(batch.column(0).offsets.to_numpy()))
        labels.append(batch.column(1).to_numpy(zero_copy_only=False).astype(float))
    if not labels:
        return
    cols = np.concatenate(lists)
    lists.clear()
    bounds = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    weights, bias = regression(bounds, cols, lambda i, j: ratios[cols[i:j]], np.concatenate(labels), len(ratios))
    yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()]), pa.array([float(bias)])], ["weights", "bias"])


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the labelled documents; ``labels`` is (doc_id, label).

    The labels are sent to all executors if a count finds at most ``BROADCAST_LABELS`` of them;
    else both sides are shuffled.
    """
    labels = labels.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    small = labels.count() <= BROADCAST_LABELS
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    return texts.join(F.broadcast(labels) if small else labels, "doc_id")


def fit(
    rows: DataFrame, fit_rows: int = FIT_ROWS, features: int = FEATURES, bits: int = BITS, counted: DataFrame | None = None
) -> GramModel:
    """The model of ``rows`` (doc_id, text, label 0/1).

    Counts cover all rows; ``counted`` (bucket, neg, pos) has them if they are known. The regression runs in one task over about ``fit_rows`` of them,
    chosen by a hash of doc_id, and over the ``features`` buckets whose counts differ most from
    what the label's share lets expect. Without rows of both labels the model is a constant.
    """
    if counted is None:
        counted = count_grams(rows.select("text", (F.col("label") == 1).alias("label")), 2, bits).toDF("bucket", "neg", "pos")
    by_label = dict(rows.groupBy((F.col("label") == 1).alias("l")).count().collect())
    pos, neg = by_label.get(True, 0), by_label.get(False, 0)
    empty = GramModel(np.zeros(1 << bits, np.float32), float(np.log((pos + 0.1) / (neg + 0.9))), bits)
    if not pos or not neg:
        return empty
    expected = F.expr(f"(pos + neg) * {pos / (pos + neg)!r}D")
    told = (F.col("pos") - expected) ** 2 / (expected + 0.5)
    best = counted.withColumn("told", told).orderBy(F.desc("told"), "bucket").limit(features).collect()
    if not best:
        return empty
    bucket = np.array([r["bucket"] for r in best])
    p, q = np.array([r["pos"] for r in best]) + 1.0, np.array([r["neg"] for r in best]) + 1.0
    ratios = np.log((p / (pos + 2)) / (q / (neg + 2)))
    index = np.full(1 << bits, -1, np.int32)
    index[bucket] = np.arange(len(bucket))
    context = rows.sparkSession.sparkContext
    shared = context.broadcast(index)
    share = int(min(1.0, fit_rows / (pos + neg)) * 1_000_000)
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < share)

    def lists(batches):
        return _chosen(batches, shared.value, bits)

    fitted = (
        chosen.select("text", F.col("label").cast("int"))
        .mapInArrow(tidy(lists), "features array<int>, label int")
        .repartition(1)
        .mapInArrow(tidy(partial(_fitted, ratios=ratios)), "weights array<double>, bias double")
        .first()
    )
    shared.destroy()
    if fitted is None:
        return empty
    table = np.zeros(1 << bits, np.float32)
    table[bucket] = np.array(fitted["weights"]) * ratios
    return GramModel(table, fitted["bias"], bits)


def with_odds(docs: DataFrame, models: list[GramModel], keep: tuple = ("doc_id",), tokens: bool = False) -> DataFrame:
    """The columns ``keep`` and an array of log-odds, one per model, for every row of ``docs``.

    ``tokens`` adds the number of words of the text.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)
    rows = docs.select(*keep, "text")
    names = [*keep, "odds"] + ["n_tokens"] * tokens

    def scored(batches):
        for batch in batches:
            for first, texts in text_chunks(batch.column(len(keep))):
                values = odds(texts, shared.value)
                bounds = np.arange(len(texts) + 1) * values.shape[1]
                columns = [batch.column(i)[first : first + len(texts)] for i in range(len(keep))]
                columns.append(K.long_lists(values.ravel(), bounds))
                if tokens:
                    columns.append(pa.array([len(t.split()) for t in texts], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names)

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    return rows.mapInArrow(tidy(scored), f"{kept}, odds array<double>" + ", n_tokens long" * tokens)
