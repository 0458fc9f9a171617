import numpy as np
import pytest

from daymark.llm.rp_forest import grow, leaf_of, nearest, opened

SCHEMA = "vec_id long, embedding array<float>, label int, key string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, every, k):
    """query -> [(distance, id)] over rows of distinct ids."""
    ids = np.array([i for i, _ in rows])
    x = np.array([np.array(v, np.float32).astype(float) for _, v in rows])
    out = {}
    for i, v in zip(ids, x, strict=True):
        if i % every == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            order = np.lexsort((ids, d))
            out[int(i)] = [(float(d[j]), int(ids[j])) for j in order if ids[j] != i][:k]
    return out


def vectors(count, width=16, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(10, width))
    return [(i, (centres[i % 10] + 0.5 * r.normal(size=width)).astype(np.float32).tolist()) for i in range(count)]


def test_whole_search_equals_brute_force(spark):
    rows = vectors(400) + [(1000 + i, vectors(1)[0][1]) for i in range(40)]
    got = {}
    for r in nearest(frame(spark, rows), every=20, trees=3, leaf=16, search=10.0, meeting=50).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    expected = brute(rows, 20, 10)
    assert set(got) == set(expected)
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        assert [f[2] for f in found] == [i for _, i in expected[q]]
        assert np.allclose([f[1] for f in found], [d for d, _ in expected[q]], rtol=1e-12, atol=1e-12)


def test_recall_of_the_production_search(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    expected = brute(rows, 10, 10)
    got = {}
    for r in nearest(df, every=10).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = sum(len(got[q] & {i for _, i in e}) for q, e in expected.items())
    assert hits / sum(len(e) for e in expected.values()) >= 0.9


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, [1.0, 2.0, 3.0]), (8, []), (None, [1.0, 1.0]), (9, [-0.0, 1.0])]
    got = sorted(tuple(r) for r in nearest(frame(spark, rows), every=100).collect())
    far = float(np.sqrt(2.0))
    assert got == [(0, 1, 100, 0.0), (0, 2, 1, far), (0, 3, 9, far), (100, 1, 0, 0.0), (100, 2, 1, far), (100, 3, 9, far)]


@pytest.mark.parametrize("rows", [[], [(0, None)], [(5, [1.0])], [(0, [1.0, 2.0])]])
def test_tables_without_neighbours(spark, rows):
    assert nearest(frame(spark, rows)).collect() == []


def test_queue_opens_the_own_leaf_first():
    x = np.random.default_rng(3).normal(size=(500, 8))
    trees = [grow(x, 20, s) for s in range(4)]
    counts = [np.bincount(leaf_of(t, x), minlength=t.leaves) for t in trees]
    assert all(c.sum() == 500 for c in counts)
    for v in x[:20]:
        first = opened(trees, counts, v, 1)
        assert first == [(first[0][0], int(leaf_of(trees[first[0][0]], v[None])[0]))]
        every = opened(trees, counts, v, 1e9)
        assert len(every) == sum((c > 0).sum() for c in counts) and len(set(every)) == len(every)


@pytest.mark.parametrize("offset", [0.0, 1e7, 1e8])
def test_ties_and_large_norms_are_ranked_exactly(spark, offset):
    """Vectors of zeros and ones, which tie by hundreds, and the same far from zero."""
    r = np.random.default_rng(8)
    step = 8.0 if offset else 1.0  # what single precision can tell apart there
    rows = [(i, (offset + step * (r.random(24) < 0.5)).astype(np.float32).tolist()) for i in range(900)]
    got = {}
    for q in nearest(frame(spark, rows), every=30, trees=2, leaf=10_000, search=100.0).collect():
        got.setdefault(q["query_id"], []).append((q["rank"], q["vec_id"], q["score"]))
    for q, expected in brute(rows, 30, 10).items():
        found = sorted(got[q])
        assert [f[1] for f in found] == [i for _, i in expected]
        assert np.allclose([f[2] for f in found], [d for d, _ in expected], rtol=1e-12)
