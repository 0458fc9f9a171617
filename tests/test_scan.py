"""Orders of any type, cut into ranges: the same results as one window, in even parts."""

import random

import pytest
from pyspark.sql import Window, functions as F
from pyspark.testing import assertDataFrameEqual

from daymark.operators.hot import _borrowed_rows, longest_run, rolling_sum, running_sum, split_by_ranges, split_hot
from daymark.operators.scan import numbered

ORDER = ["name", "id"]


@pytest.fixture(scope="module")
def texts(spark):
    """A key with most rows, half of them under one name; some names and one key are NULL."""
    rng, rows = random.Random(4), []
    for n in range(900):
        key = rng.choice(["hot"] * 8 + ["a", "b", None])
        name = None if rng.random() < 0.05 else "same" if rng.random() < 0.5 else f"n{rng.randrange(10**6)}"
        rows.append((key, name, n, rng.choice([0, 1, 2, None])))
    return spark.createDataFrame(rows, "k string, name string, id int, v int").cache()


def in_order():
    return Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_last() for c in ORDER])


@pytest.mark.parametrize("max_rows", [10, 100, 10_000])
def test_cells_are_even_and_in_order(spark, texts, max_rows):
    cut = split_by_ranges(texts, ["k"], ORDER, max_rows, {"total": F.count("v")}).cache()
    assert cut.drop("_cell", "_hot", "total").exceptAll(texts).count() == 0 and cut.count() == 900
    back = cut.withColumn("before", F.lag("_cell").over(in_order())).where("before > _cell")
    assert back.count() == 0
    hot = {r["k"]: r["h"] for r in cut.groupBy("k").agg(F.max("_hot").alias("h")).collect()}
    sizes = {r["k"]: r["count"] for r in texts.groupBy("k").count().collect()}
    assert hot == {k: n > max_rows for k, n in sizes.items()}
    totals = {(r["k"], r["total"]) for r in cut.where("_hot").select("k", "total").distinct().collect()}
    assert totals == {(r["k"], r["n"]) for r in texts.groupBy("k").agg(F.count("v").alias("n")).collect() if sizes[r["k"]] > max_rows}
    if max_rows == 100:
        parts = sorted(r["count"] for r in cut.where("_hot").groupBy("_cell").count().collect())
        assert len(parts) > 15 and parts[-1] <= 3 * parts[len(parts) // 2]


@pytest.mark.parametrize("max_rows", [10, 100, 10_000])
def test_results_equal_one_window(spark, texts, max_rows):
    so_far = F.sum("v").over(in_order().rowsBetween(Window.unboundedPreceding, 0))
    assertDataFrameEqual(running_sum(texts, ["k"], ORDER, "v", "s", max_rows), texts.withColumn("s", so_far))
    last = F.sum("v").over(in_order().rowsBetween(-29, 0))
    assertDataFrameEqual(rolling_sum(texts, ["k"], ORDER, "v", 30, "s", max_rows=max_rows), texts.withColumn("s", last))
    marked = texts.withColumn("holds", F.col("v") > 0)
    whole, cut = (longest_run(marked, ["k"], ORDER, "holds", "n", m) for m in (10_000, max_rows))
    assertDataFrameEqual(cut, whole)


def test_numbers_after_ties_of_a_text(spark, texts):
    cut = split_hot(texts, ["k"], ["id", "name"], 50)
    assert cut.groupBy("k", "_cell").count().agg(F.max("count")).first()[0] <= 60


def test_no_hot_keys_add_no_shuffle(spark, texts):
    plan = split_by_ranges(texts, ["k"], ORDER, 10_000)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


@pytest.mark.parametrize("parts", ["1", "7"])
def test_rows_are_numbered_in_one_order(spark, texts, parts):
    plain = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = numbered(texts.select("name", "id"), [F.col("name").desc_nulls_last(), F.asc("id")], "n").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", plain)
    rows = [(r["name"], r["id"]) for r in texts.collect()]
    named = sorted((r for r in rows if r[0] is not None), key=lambda r: r[1])
    expected = sorted(named, key=lambda r: r[0], reverse=True) + sorted(r for r in rows if r[0] is None)
    assert [(r["name"], r["id"]) for r in sorted(got, key=lambda r: r["n"])] == expected
    assert sorted(r["n"] for r in got) == list(range(1, 901))


def test_no_rows_have_no_numbers(spark, texts):
    assert numbered(texts.limit(0), [F.asc("id")], "n").collect() == []


def test_cells_are_more_than_tasks(spark, texts):
    cut = split_by_ranges(texts, ["k"], ORDER, 10).where("_hot")
    placed = cut.select("_cell", F.spark_partition_id().alias("task"))
    cells, tasks = placed.agg(F.countDistinct("_cell"), F.countDistinct("task")).first()
    assert cells > 300 and tasks <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert cut.groupBy("_cell").count().agg(F.max("count")).first()[0] <= 2


def test_a_cell_names_only_the_cells_that_borrow_from_it(spark, texts):
    hot = split_by_ranges(texts, ["k"], ORDER, 40).where("_hot").cache()
    borrowed = _borrowed_rows(hot, ["k"], ORDER, 29)
    sizes = [r["count"] for r in hot.groupBy("k", "_cell").count().orderBy("k", "_cell").where("k = 'hot'").collect()]
    before = [sum(sizes[:i]) for i in range(len(sizes))]
    assert borrowed.where("k = 'hot'").count() == sum(min(29, n) for n in before)
