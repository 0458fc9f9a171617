"""Whole results of the classifier queries against plain computations over all rows."""

import zlib
from collections import Counter, defaultdict
from functools import cache
from math import log

import numpy as np
from cases import documents, prose
from test_classifiers import corpus, labels

from daymark.llm.gram_model import FEATURES, grams, logistic
from daymark.llm.mixing import BUDGET, DOMAINS, PULL, TARGETS, mixture_rates
from daymark.llm.site_quality import site_quality
from daymark.llm.toxicity import toxicity


@cache
def bucket(gram):
    return int(next(grams([gram], sizes=(len(gram),)))[1][0])


def features(text):
    padded = f" {(text or '').lower()} "
    return {bucket(padded[i : i + n]) for n in (4, 5) for i in range(len(padded) - n + 1)}


def test_toxicity_scores_equal_a_plain_computation(spark):
    texts, known = corpus(80)
    texts += ["", None, prose(500, 20) + " HORRIDWORD"]
    got = {r["doc_id"]: r for r in toxicity(documents(spark, texts), labels(spark, known)).collect()}
    sets = [features(t) for t in texts]
    train = [(i, t) for i, _, t in known if zlib.crc32(str(i).encode()) % 5]
    pos = Counter(f for i, t in train if t for f in sets[i])
    neg = Counter(f for i, t in train if not t for f in sets[i])
    n_pos = sum(t for _, t in train)
    n_neg = len(train) - n_pos

    def told(f):
        expected = (pos[f] + neg[f]) * (n_pos / len(train))
        return (pos[f] - expected) ** 2 / (expected + 0.5)

    often = [f for f in {*pos, *neg} if pos[f] + neg[f] > 2]
    best = sorted(often, key=lambda f: (-told(f), f))[:FEATURES]
    ratio = np.array([log((pos[f] + 1) / (n_pos + 2)) - log((neg[f] + 1) / (n_neg + 2)) for f in best])
    x = np.array([[f in s for f in best] for s in sets]) * ratio
    rows, cols = np.nonzero(x[[i for i, _ in train]])
    values = x[[i for i, _ in train]][rows, cols]
    w, b = logistic(rows, cols, values, np.array([t for _, t in train], float), len(best))
    score = 1 / (1 + np.exp(-(x @ w + b)))
    assert len(got) == len(texts)
    for i, s in enumerate(score):
        assert abs(got[i]["score"] - s) < 1e-4 and got[i]["predicted"] == (got[i]["score"] >= 0.5)
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)


def best_rates(p, tokens, goal):
    """The rates that are best of all, by Newton steps on the three weighted misses."""
    share = tokens / tokens.sum()
    weight = np.linalg.pinv((p * share[:, None]).T @ p, rcond=1e-6, hermitian=True)

    def miss(slope):
        w = np.maximum(0, 1 - p @ slope / PULL)
        return w, weight @ ((share * w) @ p - goal) - slope

    def value(w):
        m = (share * w) @ p - goal
        return m @ weight @ m / 2 + PULL / 2 * (share * (w - 1) ** 2).sum()

    slope = np.zeros(p.shape[1])
    for _ in range(500):
        w, gap = miss(slope)
        free = p * (share * (w > 0))[:, None]
        move = np.linalg.solve(weight @ (free.T @ p) / PULL + np.eye(len(slope)), gap)
        step = 1.0
        while step > 1e-6 and np.abs(miss(slope + step * move)[1]).sum() > np.abs(gap).sum():
            step /= 2
        slope = slope + step * move
    w, gap = miss(slope)
    assert np.abs(gap).max() < 1e-8
    return w, value


def test_mixing_rates_are_as_good_as_the_best(spark):
    texts, known = corpus(300)
    rows = mixture_rates(documents(spark, texts), labels(spark, known)).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(300))
    assert all(r["n_tokens"] == len(texts[r["doc_id"]].split()) for r in rows)
    p = np.array([[r[f"p_{d}"] for d in DOMAINS] for r in rows])
    tokens, w = np.array([r["n_tokens"] for r in rows], float), np.array([r["rate"] for r in rows])
    assert np.abs(p.sum(1) - 1).max() < 1e-9 and w.min() >= 0
    best, value = best_rates(p, tokens, np.array([TARGETS[d] for d in DOMAINS]) * BUDGET)
    assert value(best) <= value(w) + 1e-12
    assert value(w) - value(best) < 1e-4


def test_site_posteriors_equal_a_plain_computation(spark):
    texts, known = corpus(240)
    site = [(f"h{i % 4}" if i % 9 else None, "en" if i % 7 else "de") for i in range(240)]
    df = spark.createDataFrame(
        [(i, t, site[i][1], site[i][0], 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long"
    )
    rows = {r["doc_id"]: r for r in site_quality(df, labels(spark, known)).collect()}
    evidence = {i: rows[i]["evidence"] for i in range(240)}

    def weight(groups):
        gap = sum(n * (s / n - m) ** 2 for n, s, m in groups)
        chance = [m * (1 - m) for _, _, m in groups]
        variance = (gap - sum(chance)) / (sum(n for n, _, _ in groups) - len(groups) + 1)
        return min(max(sum(chance) / len(chance) / variance - 1, 1.0), 100_000.0) if variance > 0 else 100_000.0

    def sums(key):
        out = defaultdict(lambda: [0, 0.0])
        for i, e in evidence.items():
            out[key(i)][0] += 1
            out[key(i)][1] += e
        return out

    rate = sum(evidence.values()) / 240
    hosts, paths = sums(lambda i: site[i][0]), sums(lambda i: site[i])
    heavy = weight([(n, s, rate) for n, s in hosts.values()])
    host = {h: (s + heavy * rate) / (n + heavy) for h, (n, s) in hosts.items()}
    heavy = weight([(n, s, host[k[0]]) for k, (n, s) in paths.items()])
    path = {k: (s + heavy * host[k[0]]) / (n + heavy) for k, (n, s) in paths.items()}
    for i, e in evidence.items():
        level = path[site[i]]
        moved = log(e / (1 - e)) + log(level / (1 - level)) - log(rate / (1 - rate))
        score = 1 / (1 + np.exp(-moved))
        assert abs(rows[i]["host_posterior"] - host[site[i][0]]) < 1e-9 and abs(rows[i]["path_posterior"] - level) < 1e-9
        assert abs(rows[i]["score"] - score) < 1e-6 and rows[i]["keep"] == (rows[i]["score"] >= 0.5)
