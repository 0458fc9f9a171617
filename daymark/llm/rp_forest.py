"""Approximate nearest neighbours: a forest of random-projection trees and exact reranking.

The trees are fitted on a bounded sample; every vector is then routed to one leaf per tree. A
query walks all trees at once through one priority queue: the node whose planes are least far
on the wrong side is opened next, whatever its tree, until the leaves opened hold the asked
number of rows. Queries meet the rows of their leaves in one task per leaf; the nearest by
exact distance are kept per leaf and then per query.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written

#: Vectors on which the trees are fitted, at most (on average; chosen by a hash of the vector).
SAMPLE = 20_000
TREES = 8
#: Sampled vectors in a leaf at most.
LEAF = 64
#: Rows in the opened leaves of a query, counted once per tree, as a share of all rows.
SEARCH = 1.0
#: Rows, and queries, of a leaf that meet in one task at most (on average).
MEETING = 20_000


@dataclass
class Tree:
    """Planes (normal, offset) and the nodes on both sides; a leaf is -1 - its number."""

    normals: np.ndarray
    offsets: np.ndarray
    sides: np.ndarray
    leaves: int


def grow(sample: np.ndarray, leaf: int, seed: int) -> Tree:
    """Split at the median along the line between the means of two random halves."""
    rng = np.random.default_rng(seed)
    normals, offsets, sides, leaves = [], [], [], 0
    todo = [(np.arange(len(sample)), None)]
    while todo:
        rows, up = todo.pop()
        normal = None
        if len(rows) > leaf:
            for _ in range(3):
                a, b = sample[rng.choice(rows, 2, replace=False)]
                for _ in range(4):
                    near = sample[rows] @ (a - b) > (a @ a - b @ b) / 2
                    if near.all() or not near.any():
                        break
                    a, b = sample[rows[near]].mean(0), sample[rows[~near]].mean(0)
                size = np.linalg.norm(a - b)
                if size > 0:
                    normal = (a - b) / size
                    place = sample[rows] @ normal
                    middle = float(np.median(place))
                    if (place > middle).any():
                        break
                    normal = None
        if normal is None:
            me, leaves = -1 - leaves, leaves + 1
        else:
            me = len(normals)
            normals.append(normal)
            offsets.append(middle)
            sides.append([0, 0])
            todo += [(rows[place <= middle], (me, 0)), (rows[place > middle], (me, 1))]
        if up:
            sides[up[0]][up[1]] = me
    width = sample.shape[1] if sample.ndim == 2 else 0
    return Tree(np.array(normals).reshape(-1, width), np.array(offsets), np.array(sides, np.int64).reshape(-1, 2), leaves)


def leaf_of(tree: Tree, vectors: np.ndarray) -> np.ndarray:
    at = np.zeros(len(vectors), np.int64) - (len(tree.sides) == 0)
    while (live := np.flatnonzero(at >= 0)).size:
        node = at[live]
        right = np.einsum("ij,ij->i", vectors[live], tree.normals[node]) > tree.offsets[node]
        at[live] = tree.sides[node, right.astype(int)]
    return -1 - at


def opened(trees: list[Tree], counts: list[np.ndarray], vector: np.ndarray, rows: float) -> list[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue until the leaves hold ``rows`` rows."""
    beyond = [t.normals @ vector - t.offsets if len(t.sides) else None for t in trees]
    queue = [(-np.inf, k, 0 if len(t.sides) else -1) for k, t in enumerate(trees)]
    out, held = [], 0
    while queue and held < rows:
        worst, k, node = heapq.heappop(queue)
        if node < 0:
            if counts[k][-1 - node]:
                out.append((k, -1 - node))
                held += counts[k][-1 - node]
            continue
        margin = beyond[k][node]
        left, right = trees[k].sides[node]
        heapq.heappush(queue, (max(worst, margin), k, int(left)))
        heapq.heappush(queue, (max(worst, -margin), k, int(right)))
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding as doubles) that can take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('inf'))"
    return rows.where(f"vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND {finite} AND exists(embedding, x -> x <> 0)")


def nearest(
    vectors: DataFrame, every: int = 100, k: int = 10, trees: int = TREES, leaf: int = LEAF,
    sample: int = SAMPLE, search: float = SEARCH, meeting: int = MEETING,
) -> DataFrame:
    """For rows of ``vectors`` (vec_id, embedding) whose vec_id is divisible by ``every``: the
    ``k`` nearest other rows found, as query_id, rank (from 1), vec_id, score.

    The score is the Euclidean distance in double precision, ties go to the smaller vec_id.
    Vectors that are null, zero, empty or hold null or non-finite components take no part, nor
    do vectors of another length than the most frequent (the smaller on a tie). Equal vectors
    are indexed once with their k + 1 least ids, which loses no result. Repeated rows of one
    vec_id count once. A query with fewer candidates gets all that were found; empty tables
    give an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors)
    widths = rows.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count"), "w").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if widths is None:
        return empty
    width = widths["w"]
    rows = rows.where(F.size("embedding") == width).withColumn("embedding", F.expr("transform(embedding, x -> x + 0.0D)"))
    ids = rows.select(F.xxhash64("embedding").alias("key"), "vec_id", "embedding").distinct()
    first = Window.partitionBy("key").orderBy("vec_id")
    ranked = written(ids.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1), "vectors")
    distinct = ranked.where("r = 1").select("key", "embedding", F.col("vec_id").alias("least"))
    count = distinct.count()
    share = int(min(1.0, sample / count) * 1_000_000) + 1
    fitted = distinct.where(F.pmod(F.xxhash64("key", F.lit(7)), F.lit(1_000_000)) < share).select("embedding").toArrow()
    fitted = _matrix(fitted.column(0).combine_chunks(), width) if len(fitted) else np.zeros((0, width))
    forest = [grow(fitted, leaf, seed) for seed in range(trees)]
    context = spark.sparkContext
    shared = context.broadcast(forest)

    def routed(batches):
        for batch in batches:
            matrix = _matrix(batch.column(1), width)
            for t, tree in enumerate(shared.value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(matrix), t, np.int32)), pa.array(leaf_of(tree, matrix)), *batch.columns],
                    ["tree", "leaf", "key", "embedding", "least"],
                )

    index = distinct.mapInArrow(routed, "tree int, leaf long, key long, embedding array<double>, least long")
    index = written(index, "leaves")
    sizes = [np.zeros(t.leaves, np.int64) for t in forest]
    # One row per leaf; their number follows from the sample, not from the table.
    for r in index.groupBy("tree", "leaf").count().collect():
        sizes[r["tree"]][r["leaf"]] = r["count"]
    counts = context.broadcast(sizes)

    def walked(batches):
        for batch in batches:
            matrix = _matrix(batch.column(1), width)
            found = [opened(shared.value, counts.value, v, search * count) for v in matrix]
            each = np.array([len(f) for f in found])
            flat = np.array([p for f in found for p in f], np.int64).reshape(-1, 2)
            which = pa.array(np.repeat(np.arange(len(found)), each))
            yield pa.RecordBatch.from_arrays(
                [pa.array(flat[:, 0].astype(np.int32)), pa.array(flat[:, 1]), batch.column(0).take(which), batch.column(1).take(which)],
                ["tree", "leaf", "key", "embedding"],
            )

    asked = ids.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "key", "embedding")
    asked = written(asked, "queries")
    walkers = asked.select("key", "embedding").dropDuplicates(["key"])
    probes = written(walkers.mapInArrow(walked, "tree int, leaf long, key long, embedding array<double>"), "probes")
    parts = (
        index.groupBy("tree", "leaf").count().join(probes.groupBy("tree", "leaf").agg(F.count("*").alias("q")), ["tree", "leaf"])
        .select("tree", "leaf", F.expr(f"CAST(ceil(count / {meeting}) AS INT)").alias("a"), F.expr(f"CAST(ceil(q / {meeting}) AS INT)").alias("b"))
    )
    # A crowded leaf is cut into parts of rows and parts of queries; each pair of parts meets once.
    left = index.join(parts, ["tree", "leaf"]).select(
        "tree", "leaf", F.expr("pmod(xxhash64(key), a)").alias("i"), F.explode(F.sequence(F.lit(0), F.col("b") - 1)).alias("j"), "key", "embedding", "least"
    )
    right = probes.join(parts, ["tree", "leaf"]).select(
        "tree", "leaf", F.explode(F.expr("sequence(0L, CAST(a - 1 AS BIGINT))")).alias("i"), F.expr("CAST(pmod(xxhash64(key), b) AS INT)").alias("j"), "key", "embedding"
    )

    def met(a: pa.Table, b: pa.Table) -> pa.Table:
        names = ["query", "key", "score"]
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if len(a) and len(b):
            row_keys, query_keys = a.column("key").to_numpy(), b.column("key").to_numpy()
            least = a.column("least").to_numpy()
            x, q = (_matrix(t.column("embedding").combine_chunks(), width) for t in (a, b))
            top, parts_out = min(k + 1, len(x)), []
            # Rough distances are taken around the middle of the leaf, where little cancels.
            middle = x.mean(0)
            around, size = x - middle, np.sqrt(width) * max(np.abs(x).max(), np.abs(q).max())
            norms = (around**2).sum(1)
            far = np.sqrt(norms.max())
            for s in range(0, len(q), 256):
                block, near = q[s : s + 256], q[s : s + 256] - middle
                rough = norms - 2 * near @ around.T
                # All rows that rounding could put among the first, and all ties, are ranked exactly.
                reach = far + np.sqrt((near**2).sum(1))
                slack = 8 * np.finfo(float).eps * (width + 4) * reach * (reach + size)
                limit = np.partition(rough, top - 1, axis=1)[:, top - 1] + slack
                line, column = np.nonzero(rough <= limit[:, None])
                exact = np.empty(len(line))
                for c in range(0, len(line), 1 << 14):
                    gap = x[column[c : c + (1 << 14)]] - block[line[c : c + (1 << 14)]]
                    exact[c : c + (1 << 14)] = np.sqrt((gap**2).sum(1))
                order = np.lexsort((least[column], exact, line))
                line, column, exact = line[order], column[order], exact[order]
                first = np.arange(len(line)) - np.searchsorted(line, line) < top
                parts_out.append([query_keys[s : s + 256][line[first]], row_keys[column[first]], exact[first]])
            out = [np.concatenate(c) for c in zip(*parts_out, strict=True)]
        return pa.table(dict(zip(names, out, strict=True)))

    pairs = (
        left.groupBy("tree", "leaf", "i", "j").cogroup(right.groupBy("tree", "leaf", "i", "j"))
        .applyInArrow(met, "query long, key long, score double")
    )
    # A leaf may be met in several trees: a pair counts once.
    pairs = pairs.groupBy("query", "key").agg(F.min("score").alias("score"))
    least = ranked.where("r = 1").select("key", F.col("vec_id").alias("least"))
    nearest_first = Window.partitionBy("query").orderBy("score", "least")
    pairs = pairs.join(least, "key").withColumn("r", F.row_number().over(nearest_first)).where(F.col("r") <= k + 1)
    found = pairs.select(F.col("query").alias("qk"), "key", "score").join(ranked.select("key", "vec_id"), "key")
    found = asked.select("query_id", F.col("key").alias("qk")).join(found, "qk").where("vec_id <> query_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
