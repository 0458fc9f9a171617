import pytest
from cases import awkward, documents, edited, prose, shingles

from daymark.llm.containment import contained, without_items


def items(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


def brute(texts, tests, share=75):
    out = {}
    for d, t in texts:
        for i, x in enumerate(tests):
            own, item = shingles((t or "").lower()), shingles((x or "").lower())
            if d is not None and item and 100 * len(own & item) >= share * len(item):
                out[d, i] = (len(item), len(own & item))
    return out


def test_equals_counting(spark):
    tests = [prose(k, 10 + 7 * k) for k in range(8)] + ["four words are few", "", None]
    texts = [prose(50 + k, 300) + " " + edited(tests[k % 8], k, k % 4) + " " + prose(70 + k, 50) for k in range(24)]
    texts += ["four words are few", "FOUR words  are\nfew", "four words are few and more", None, ""]
    got = {(r["doc_id"], r["item_id"]): (r["n_item"], r["n_found"]) for r in contained(documents(spark, texts), items(spark, tests)).collect()}
    assert got == brute(list(enumerate(texts)), tests)
    assert 8 < len(got) < 30


def test_awkward_rows(spark):
    df = awkward(spark)
    tests = [prose(1, 60), prose(2, 20_000), None]
    got = {(r["doc_id"], r["item_id"]) for r in contained(df, items(spark, tests)).collect()}
    assert got == set(brute([(r["doc_id"], r["text"]) for r in df.collect()], tests))
    kept = without_items(df, items(spark, tests))
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([4, 5, 6, 7, 8, None, None, 11, 11, 12], key=str)


@pytest.mark.parametrize("texts,tests", [([], ["a b c d e f"]), (["a b c d e f"], []), ([], [])])
def test_empty_tables(spark, texts, tests):
    assert contained(documents(spark, texts), items(spark, tests)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    from daymark.llm.queries import QUERIES

    plan = QUERIES["op6_containment"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_query_equals_its_sql(spark, sf_dir):
    from compare import connect, differences

    from daymark.llm.queries import ORACLES, QUERIES

    for name, sql in ORACLES.items():
        assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), sql) == ""
