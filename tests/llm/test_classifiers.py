import zlib

import numpy as np
import pytest
from cases import awkward, documents, prose
from pyspark.sql import functions as F

from daymark.llm.gram_model import distinct, fit, logistic
from daymark.llm.mixing import DOMAINS, held_out, mixed, mixture_rates, rates, solve, train
from daymark.llm.site_quality import prior_weight, site_quality
from daymark.llm.toxicity import toxicity, without_toxic


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def corpus(count=200):
    """Every fifth text is toxic, every third of the others is poor."""
    texts, known = [], []
    for i in range(count):
        toxic, poor = i % 5 == 0, i % 3 == 0
        text = prose(i, 40)
        if toxic:
            text = text[:100] + " horridword nastyphrase " + text[100:]
        if poor:
            text = text.replace(" ", "### ")
        texts.append(text)
        known.append((i, int(not poor), int(toxic)))
    return texts, known


def test_held_out_rows_are_told_apart(spark):
    texts, known = corpus()
    wrong = [(i, q, 1 - t) if zlib.crc32(str(i).encode()) % 5 == 0 else (i, q, t) for i, q, t in known]
    rows = toxicity(documents(spark, texts), labels(spark, wrong)).collect()
    assert len(rows) == 200
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == (r["score"] >= 0.5) == (r["doc_id"] % 5 == 0)


def test_toxic_rows_go_and_others_stay_whole(spark):
    texts, known = corpus()
    docs = documents(spark, texts)
    kept = without_toxic(docs, labels(spark, known))
    assert sorted(kept.collect()) == sorted(docs.where("doc_id % 5 <> 0").collect())


@pytest.mark.parametrize("known", [[], [(1, 1, 0)], [(1, None, None), (None, 1, 1)], [(9999, 1, 1)]])
def test_too_few_labels_give_a_constant(spark, known):
    rows = toxicity(awkward(spark), labels(spark, known)).collect()
    assert len(rows) == 15 and len({r["score"] for r in rows}) == 1 and rows[0]["predicted"] == 0
    assert mixture_rates(awkward(spark), labels(spark, known)).count() == 15
    assert site_quality(awkward(spark), labels(spark, known)).count() == 15


def test_empty_documents(spark):
    none = documents(spark, [])
    for known in ([], [(1, 1, 0)]):
        assert toxicity(none, labels(spark, known)).collect() == []
        assert mixture_rates(none, labels(spark, known)).collect() == []
        assert site_quality(none, labels(spark, known)).collect() == []
        assert mixed(none, labels(spark, known)).collect() == []


def test_awkward_rows_are_all_scored(spark):
    known = [(i, i % 2, (i + 1) % 2) for i in range(1, 13)] * 2
    rows = toxicity(awkward(spark), labels(spark, known)).collect()
    assert len(rows) == 15 and all(0 <= r["score"] <= 1 for r in rows)
    empty = {round(r["score"], 12) for r in rows if r["doc_id"] in (4, 5)}
    assert len(empty) == 1


def test_distinct_grams_equal_sets():
    texts = [" abcab abcab ", " abcab ", "  ", " é✓𝒳é✓𝒳 "]
    row, bucket = distinct(texts, 20, (4, 5))
    counts = np.bincount(row, minlength=4)
    assert counts.tolist() == [len({t[i : i + n] for n in (4, 5) for i in range(len(t) - n + 1)}) for t in texts]
    assert len(set(zip(row.tolist(), bucket.tolist(), strict=True))) == len(row)


def test_logistic_reaches_a_small_slope():
    r = np.random.default_rng(1)
    x = r.random((300, 8)) < 0.4
    y = (x[:, 0] & ~x[:, 1]).astype(float)
    rows, cols = np.nonzero(x)
    w, b = logistic(rows, cols, np.ones(len(rows)), y, 8, 1e-3, 2000)
    p = 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ (p - y) / 300 + 1e-3 * w).max() < 1e-3 and ((p > 0.5) == (y > 0.5)).mean() > 0.97


def test_counts_follow_the_labels(spark):
    docs = documents(spark, ["zzzz qqqq"] * 30 + ["yyyy xxxx"] * 30)
    model = fit(docs.withColumn("label", (F.col("doc_id") < 30).cast("int")))
    _, bucket = distinct([" zzzz qqqq "])
    assert (model.table[bucket] > 0).all()


def test_rates_meet_the_targets(spark):
    r = np.random.default_rng(5)
    p = r.dirichlet([2, 1, 0.3], 3000)
    tokens = r.integers(1, 500, 3000)
    table = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, p, strict=True)], "n_tokens long, p array<double>")
    targets = {"good": 0.7, "poor": 0.25, "toxic": 0.05}
    w, _ = rates(p, solve(table, targets, 0.8))
    got = (tokens * w) @ p / tokens.sum()
    assert w.min() >= 0
    assert np.abs(got - 0.8 * np.array([targets[d] for d in DOMAINS])).max() < 2e-3


def test_domain_counts_cover_all_labels(spark):
    """A word in four toxic texts tells, however few rows the regression sees."""
    texts = [prose(k, 20) + (" zzqqzz" if k % 40 == 0 else "") for k in range(160)]
    docs, table = documents(spark, texts), labels(spark, [(k, int(k % 3 > 0), int(k % 40 == 0)) for k in range(160)])
    models = train(docs, table, fit_rows=40)
    known = docs.withColumn("label", (F.col("doc_id") % 40 == 0).cast("int"))
    assert np.array_equal(models[0].table, fit(known, 40).table)
    # With all rows in the regression both models are those of their rows alone.
    models = train(docs, table)
    assert np.array_equal(models[0].table, fit(known).table)
    rest = docs.where("doc_id % 40 <> 0").withColumn("label", (F.col("doc_id") % 3 > 0).cast("int"))
    assert np.array_equal(models[1].table, fit(rest).table)


def test_posteriors_hold_on_held_out_labels(spark):
    texts, known = corpus(400)
    got = {r["domain"]: r for r in held_out(documents(spark, texts), labels(spark, known)).collect()}
    out = [(q, t) for i, q, t in known if zlib.crc32(str(i).encode()) % 5 == 0]
    texts = {"good": sum(q and not t for q, t in out), "poor": sum(not q and not t for q, t in out), "toxic": sum(t for _, t in out)}
    assert {d: r["texts"] for d, r in got.items()} == texts
    for d, n in texts.items():
        assert abs(got[d]["expected"] - n) < 0.1 * len(out) and got[d]["log_loss"] < 0.3


def test_mixed_rows_follow_their_rates(spark):
    texts, known = corpus()
    docs, table = documents(spark, texts), labels(spark, known)
    rate = {r["doc_id"]: r["rate"] for r in mixture_rates(docs, table, budget=1.3).collect()}
    drawn = mixed(docs, table, budget=1.3)
    assert drawn.columns == docs.columns
    count = {r["doc_id"]: r["count"] for r in drawn.groupBy("doc_id").count().collect()}
    for i, w in rate.items():
        assert int(w + 1e-6) <= count.get(i, 0) <= int(w) + 1
    assert sorted(mixed(docs, table, budget=1.3).collect()) == sorted(drawn.collect())


def test_sparse_sites_follow_their_host(spark):
    texts, known, docs = [], [], []
    for i in range(300):
        bad = (i % 3 == 0) if i % 10 else (i % 20 == 0)
        text = prose(i, 30)
        texts.append(text.replace(" ", "### ") if bad else text)
        known.append((i, int(not bad), 0))
        docs.append((i, texts[-1], "en" if i else "rare", f"h{i % 3}", 0))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    rows = {r["doc_id"]: r for r in site_quality(df, labels(spark, known)).collect()}
    assert len(rows) == 300
    assert rows[3]["host_posterior"] < rows[4]["host_posterior"]
    assert abs(rows[0]["path_posterior"] - rows[0]["host_posterior"]) < 0.3
    assert sum(rows[i]["keep"] == q for i, q, _ in known) > 285


def test_prior_weight_recovers_the_spread(spark):
    r = np.random.default_rng(2)
    a, b = 6.0, 14.0
    groups = [(40, float(r.binomial(40, r.beta(a, b)))) for _ in range(3000)]
    got = prior_weight(spark.createDataFrame(groups, "n long, s double"), 0.3).first()["weight"]
    assert 15 < got < 27
    same = [(40, 12.0)] * 50
    assert prior_weight(spark.createDataFrame(same, "n long, s double"), 0.3).first()["weight"] == 100_000.0
