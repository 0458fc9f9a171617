"""Match facts, salted joins and size-checked broadcasts."""

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daymark.operators.matches import (
    average_per_match,
    count_matches,
    enrich,
    medal_total,
    played_matches,
    salt_hot_keys,
)


def test_kills_do_not_multiply_with_medal_rows(spark):
    details = spark.createDataFrame(
        [("m1", "p", 10), ("m2", "p", 20), ("m1", "q", 12)], "match string, player string, kills int"
    )
    rows = average_per_match(details, "player", "match", "kills", "average").collect()
    assert {r.player: (r.total_kills, r.games_played, r.average) for r in rows} == {
        "p": (30, 2, 15.0),
        "q": (12, 1, 12.0),
    }


def test_matches_count_once_and_only_if_played(spark):
    matches = spark.createDataFrame(
        [("m1", "slayer"), ("m2", "slayer"), ("m3", "ctf")], "match string, playlist string"
    )
    facts = spark.createDataFrame([("m1",), ("m1",), ("m3",)], "match string")
    played = played_matches(matches, facts, "match")
    rows = count_matches(played, "playlist", "match", "n").collect()
    assert {r.playlist: r.n for r in rows} == {"slayer": 1, "ctf": 1}


def test_medals_by_map(spark):
    counts = spark.createDataFrame(
        [("m1", 1, 2), ("m1", 2, 9), ("m2", 1, 5), ("m3", 1, 1)], "match string, medal int, n int"
    )
    matches = spark.createDataFrame(
        [("m1", "x"), ("m2", "y"), ("m3", "x")], "match string, map string"
    )
    medals = spark.createDataFrame([(1, "spree"), (2, "other")], "medal int, name string")
    rows = medal_total(
        counts, matches, medals, F.col("name") == "spree", "match", "medal", "map", "n", "total"
    ).collect()
    assert {r.map: r.total for r in rows} == {"x": 3, "y": 5}


def test_no_job_runs_while_a_query_is_built(spark):
    facts = spark.range(100).select((F.col("id") % 10).alias("k"), "id")
    dim = spark.range(10).select(F.col("id").alias("k"), F.lit("n").alias("name"))
    spark.sparkContext.setJobGroup("build", "build")
    joined = enrich(facts, [(dim, "k", "dim")])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("other", "other")
    assert list(jobs) == [] and joined.columns == ["k", "id", "dim_name"] and joined.count() == 100


def test_salted_join_gives_the_same_rows(spark):
    facts = spark.range(600).select(
        F.when(F.col("id") < 400, F.lit(7)).otherwise(F.col("id") % 50).alias("k"), "id"
    )
    lookup = spark.range(60).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    left, right = salt_hot_keys(facts, lookup, "k", 50)
    joined = left.join(right, ["k", "salt"]).drop("salt")
    assertDataFrameEqual(joined, facts.join(lookup, "k"))
    salts = {r.k: r.n for r in left.groupBy("k").agg(F.countDistinct("salt").alias("n")).collect()}
    assert salts.pop(7) == 9 and set(salts.values()) == {1}
    assert left.groupBy("k", "salt").count().agg(F.max("count")).first()[0] < 100
