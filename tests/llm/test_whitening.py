import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm.whitening import WIDE, eigenvectors, moments, usable, whitened

SCHEMA = "vec_id long, embedding array<float>"


def table(spark, vectors, first=0):
    rows = [(first + i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumn("c", F.lit("clash")).withColumn("n", F.lit(1)).withColumn("component", F.lit(""))


def whole(vectors):
    return [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]


def check(rows, ids, vectors, components=32):
    """All columns against exact fractions and the definition of an eigenvector."""
    x = whole(vectors)
    n, width = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x, strict=True)]
    centred = [[Fraction(n * a - s, n) for a, s in zip(v, sums, strict=True)] for v in x]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for i, v in zip(ids, x, strict=True)}
    d = np.array(centred, float)
    values = np.linalg.eigvalsh(d.T @ d / n)[::-1]
    kept = min(components, width, int((values > 1e-12 * values[0]).sum()))
    by_component = defaultdict(dict)
    for r in rows:
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        by_component[r["component"]][r["vec_id"]] = r
    assert sorted(by_component) == list(range(1, kept + 1)) and len(rows) == n * kept
    z = np.array([[by_component[k][i]["whitened"] for i in ids] for k in range(1, kept + 1)])
    covariance = np.cov(z, bias=True).reshape(kept, kept)
    error = np.abs(covariance - np.eye(kept)).max()
    assert error < 1e-10 and {abs(r["identity_error"] - error) < 1e-11 for r in rows} == {True}
    for k in range(kept):
        told = {r["explained"] for r in by_component[k + 1].values()}
        assert len(told) == 1 and told.pop() == pytest.approx(values[k] / values.sum(), rel=1e-9)
    # Projections: z = d v / sqrt(e), so C z' gives back each direction, and it is an eigenvector.
    v = (d.T @ z.T) / n / np.sqrt(values[:kept])
    residual = d.T @ (d @ v) / n - v * values[:kept]
    assert np.abs(residual).max() < 1e-10 * values[0]
    assert np.abs((v * v).sum(0) - 1).max() < 1e-9


def test_equals_definition(spark):
    r = np.random.default_rng(1)
    vectors = (r.normal(size=(300, 40)) @ r.normal(size=(40, 40)) * 0.3).astype(np.float32)
    rows = whitened(table(spark, vectors).repartition(5)).collect()
    check(rows, range(300), vectors)


def test_query(spark, sf_dir):
    from daymark.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    result = QUERIES["op13_whitening"](spark, sf_dir).collect()
    check(result, [r["vec_id"] for r in rows], [r["embedding"] for r in rows])
    assert max(r["identity_error"] for r in result) < 1e-4


def test_awkward_vectors_take_no_part(spark):
    r = np.random.default_rng(2)
    good = r.normal(size=(50, 3)).astype(np.float32).tolist()
    bad = [None, [], [None, 1, 2], [float("nan"), 1, 2], [1, float("inf"), 2], [1, 2, -float("inf")], [1, 2], [1, 2, 3, 4], [None]]
    df = table(spark, good + bad + good[:7]).withColumn("vec_id", F.when(F.col("vec_id") != 0, F.col("vec_id")))
    rows = whitened(df).collect()
    ids = [None, *range(1, 50), *range(59, 66)]
    check(rows, ids, good + good[:7])


def test_large_numbers_stay_exact(spark):
    vectors = [[1e9, 5e11, -3.5], [1e9 + 64, 5e11, 7], [-2e9, 5e11 + 2**20, 0], [3, 4, 5]]
    found = moments(usable(table(spark, vectors)))
    x = whole(vectors)
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = [[sum(Fraction(4 * v[i] - sums[i], 4) * Fraction(4 * v[j] - sums[j], 4) for v in x) / 4 for j in range(3)] for i in range(3)]
    assert found.sums == sums
    got = found.covariance()
    assert all(abs(float(got[i, j]) / float(exact[i][j]) - 1) < 1e-15 for i in range(3) for j in range(3))


@pytest.mark.parametrize("vectors", [[], [None], [[1, 2]], [[1, 2], [1, 2], [1, 2]]])
def test_nothing_to_whiten(spark, vectors):
    assert whitened(table(spark, vectors)).collect() == []


def test_directions_without_spread_are_left_out(spark):
    r = np.random.default_rng(3)
    line = r.normal(size=60)
    vectors = np.stack([line, np.ones(60), 2 * np.round(64 * line) / 64 * 0 + 3, r.normal(size=60)], 1).astype(np.float32)
    check(whitened(table(spark, vectors)).collect(), range(60), vectors)
    assert {x["component"] for x in whitened(table(spark, vectors), components=1).collect()} == {1}


def orthogonal(r, n):
    return np.linalg.qr(r.normal(size=(n, n)))[0].astype(WIDE)


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(5, 1, 30),
        [3, 3, 3, 2, 2, 1, 0.5],
        [1 + 1e-9, 1, 1 - 1e-9, 0.5, 0.5 + 3e-8, 0.1],
        [1 + 1e-13, 1, 0.3, 1e-6, 1e-6 + 1e-14],
        [1e6, 1, 1e-4],
        [7.0],
        [0, 0],
    ],
)
def test_refinement_reaches_double_precision(values):
    r = np.random.default_rng(5)
    values = np.sort(np.asarray(values, float))[::-1].astype(WIDE)
    q = orthogonal(r, len(values))
    for _ in range(2):  # orthogonal in higher precision as well
        q = q @ (WIDE(1.5) * np.eye(len(q), dtype=WIDE) - q.T @ q / 2)
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, x = eigenvectors(a)
    top = float(abs(values).max()) or 1.0
    assert np.abs(found - values).max() <= 1e-17 * len(values) * top * 10
    assert np.abs(x.T @ x - np.eye(len(x))).max() < 1e-16
    assert np.abs(a @ x - x * found).max() < 1e-16 * top * len(values)
    for k, v in enumerate(values):  # eigenvectors themselves, where the gap fixes them
        gap = min((abs(float(v - w)) for j, w in enumerate(values) if j != k), default=1.0)
        if gap > 0:
            assert abs(abs(float(q[:, k] @ x[:, k])) - 1) < 1e-15 + (1e-18 * len(values) * top / gap) ** 2


def test_single_precision_alone_is_not_enough():
    """The start that the refinement mends: its error is that of float32."""
    r = np.random.default_rng(6)
    a = r.normal(size=(20, 20))
    a = a @ a.T
    _, x = np.linalg.eigh(a.astype(np.float32))
    assert np.abs(x.T.astype(float) @ x - np.eye(20)).max() > 1e-8
    _, y = eigenvectors(a)
    assert np.abs(y.T @ y - np.eye(20)).max() < 1e-17
