"""Tables in versions: what deletes and upserts leave alone, and what a failed check hides."""

import os
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from daymark.sources.versions import (
    FILE,
    _located,
    delete_from,
    latest_version,
    publish,
    read_rejects,
    read_version,
    upsert_into,
    version_files,
)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def stamps(files):
    return {f: os.stat(unquote(f.removeprefix("file://"))).st_mtime_ns for f in files}


@pytest.fixture
def stored(spark, tmp_path):
    """100 rows in ten files, ten keys in a row each; the path has blanks and a percent sign."""
    path = str(tmp_path / "a b%c")
    upsert_into(spark, path, spark.range(100).selectExpr("id", "id * 2 AS v").repartitionByRange(10, "id"), ["id"])
    return path


def test_a_delete_writes_only_the_files_that_it_touches(spark, stored):
    before = version_files(spark, stored)
    kept = stamps(before)
    assert len(before) == 10
    hit = delete_from(spark, stored, spark.createDataFrame([(11,), (12,), (55,), (1000,), (None,)], "id long"), ["id"])
    after = version_files(spark, stored)
    assert len(hit) == 2 and set(before) - set(after) == set(hit)
    assert {f: t for f, t in kept.items() if f in after} == stamps(set(before) & set(after))
    assert rows(read_version(spark, stored)) == [(i, 2 * i) for i in sorted(set(range(100)) - {11, 12, 55}, key=lambda i: str((i, 2 * i)))]
    assert read_version(spark, stored, 1).count() == 100 and latest_version(spark, stored) == 2


def test_a_delete_of_nothing_makes_no_version(spark, stored):
    assert delete_from(spark, stored, spark.createDataFrame([(-1,)], "id long"), ["id"]) == []
    assert latest_version(spark, stored) == 1


def test_all_rows_can_go(spark, stored):
    delete_from(spark, stored, spark.range(100), ["id"])
    assert read_version(spark, stored).count() == 0


def test_an_upsert_replaces_and_adds(spark, stored):
    before = version_files(spark, stored)
    changed = spark.createDataFrame([(5, -1), (200, -2), (None, -3)], "id long, v long")
    hit = upsert_into(spark, stored, changed, ["id"])
    assert len(hit) == 1 and len(set(before) & set(version_files(spark, stored))) == 9
    again = upsert_into(spark, stored, changed, ["id"])
    assert len(again) >= 1
    expected = [(i, 2 * i) for i in range(100) if i != 5] + [(5, -1), (200, -2), (None, -3)]
    assert rows(read_version(spark, stored)) == sorted(expected, key=str)


def test_files_without_a_version_are_not_seen(spark, stored):
    """As a run leaves them that was ended before its version was listed."""
    spark.range(5).selectExpr("id", "id AS v").write.parquet(f"{stored}/data/run=lost")
    assert read_version(spark, stored).count() == 100




@pytest.fixture
def rules(spark):
    return {"positive": F.col("v") > 0, "small": F.col("v") < 100}


GOOD = [(1, 5), (2, 6), (3, 7)]
BAD = [(4, 0), (5, 500), (6, None), (7, 8), (7, 9), (None, 3)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, v long")


def test_a_failed_check_leaves_readers_on_the_old_version(spark, tmp_path, rules):
    path = str(tmp_path / "t")
    first = publish(frame(spark, GOOD), path, rules, ["id"])
    assert (first.version, first.accepted, first.rejected) == (1, 3, 0)
    failed = publish(frame(spark, GOOD[:1] + BAD), path, rules, ["id"], max_rejected=0.5)
    assert (failed.version, failed.accepted, failed.rejected) == (None, 0, 6)
    assert rows(read_version(spark, path)) == GOOD and latest_version(spark, path) == 1
    rejects = {(r["id"], r["v"]): r["rules"] for r in read_rejects(spark, path, failed.run).collect()}
    assert rejects == {
        (4, 0): ["positive"], (5, 500): ["small"], (6, None): ["positive", "small"],
        (7, 8): ["key"], (7, 9): ["key"], (None, 3): ["key"],
    }
    passed = publish(frame(spark, [(9, 9)] + BAD), path, rules, ["id"], max_rejected=0.9, append=True)
    assert (passed.version, passed.accepted, passed.rejected) == (2, 1, 6)
    assert rows(read_version(spark, path)) == GOOD + [(9, 9)]
    replaced = publish(frame(spark, [(8, 8)]), path, rules, ["id"])
    assert replaced.version == 3 and rows(read_version(spark, path)) == [(8, 8)]


def test_checked_and_merged_rows_stay_one_table(spark, tmp_path, rules):
    path = str(tmp_path / "t")
    publish(frame(spark, GOOD), path, rules, ["id"])
    upsert_into(spark, path, frame(spark, [(2, 60), (10, 1)]), ["id"])
    delete_from(spark, path, frame(spark, [(1, 0)]), ["id"])
    assert rows(read_version(spark, path)) == sorted([(2, 60), (3, 7), (10, 1)], key=str)


def test_an_empty_run(spark, tmp_path, rules):
    path = str(tmp_path / "t")
    publish(frame(spark, GOOD), path, rules, ["id"])
    done = publish(frame(spark, []), path, rules, ["id"], append=True)
    assert (done.version, done.accepted) == (2, 0) and rows(read_version(spark, path)) == GOOD


def test_rows_meet_keys_without_the_names_of_their_files(spark, stored):
    files = version_files(spark, stored)
    located = _located(spark, files, ["id"])
    assert [(c, t) for c, t in located.dtypes] == [("id", "bigint"), (FILE, "bigint")]
    assert located.groupBy(FILE).count().count() == len(files) == 10
