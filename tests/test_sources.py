"""Readers, writers and storage layout."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daymark.session import new_path, shared_folder
from daymark.sources import readers, schemas, writers
from daymark.sources.layout import compare_layouts, file_report


def day(n):
    return dt.date(2024, 1, n)


def test_csv_with_header(spark, tmp_path):
    (tmp_path / "maps.csv").write_text("map_id,name\nm1,One\nm2,\n")
    df = readers.read_csv(spark, str(tmp_path), schemas.MAPS)
    assert df.schema == schemas.MAPS
    assert [tuple(r) for r in df.orderBy("map_id").collect()] == [("m1", "One"), ("m2", None)]


def test_series(spark):
    numbers = readers.integer_series(spark, 1970, 2022, "year").collect()
    assert [r.year for r in numbers] == list(range(1970, 2023))
    days = readers.date_series(spark, "2023-01-01", "2023-01-31").collect()
    assert len(days) == 31 and days[-1].day == dt.date(2023, 1, 31)


def test_sql_over_frames_and_views(spark):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    assert readers.run_sql(spark, "SELECT sum(n) AS s FROM {numbers}", numbers=df).first().s == 3
    readers.register_views(numbers_view=df)
    assert readers.read_table(spark, "numbers_view").count() == 2


def test_json_events(spark):
    raw = spark.createDataFrame(
        [(bytearray(b'{"window_timestamp":"2024-01-01T00:00:00Z","ip":"1","host":"h"}'),)],
        "value binary",
    )
    row = readers.parse_events(raw, schemas.STREAM_EVENTS).first()
    assert (row.ip, row.host, row.window_timestamp) == ("1", "h", dt.datetime(2024, 1, 1))


def test_as_schema(spark):
    df = spark.createDataFrame([("x", "b")], "browser_type string, device_id string")
    with pytest.raises(Exception):
        schemas.as_schema(df, schemas.DEVICES).collect()
    good = spark.createDataFrame([("x", "7", 1)], "browser_type string, device_id string, n int")
    row = schemas.as_schema(good, schemas.DEVICES).first()
    assert row.asDict() == {"device_id": 7, "browser_type": "x"}


def test_overwrite_table(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    for path in (None, str(tmp_path / "t")):
        name = f"numbers_{'path' if path else 'managed'}"
        writers.overwrite_table(df, name, path)
        writers.overwrite_table(df.where("n = 1"), name, path)
        assert [r.n for r in readers.read_table(spark, name).collect()] == [1]


def test_a_snapshot_replaces_only_its_own_partition(spark, tmp_path):
    path = str(tmp_path / "hosts")
    schema = "host string, c_date date"
    for n, hosts in ((1, "ab"), (2, "abc"), (2, "ad")):
        rows = [(h, day(n)) for h in hosts]
        writers.write_snapshot(spark.createDataFrame(rows, schema), path, "c_date")
    table = readers.read_parquet(spark, path)
    assert sorted((r.c_date.day, r.host) for r in table.collect()) == [
        (1, "a"),
        (1, "b"),
        (2, "a"),
        (2, "d"),
    ]
    one = readers.read_snapshot(spark, path, "c_date", day(2))
    assert sorted(r.host for r in one.collect()) == ["a", "d"]
    assert "PartitionFilters: [isnotnull(c_date" in one._jdf.queryExecution().toString()


def test_upsert_replaces_by_key_within_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "months")
    schema = "host string, month_start date, hits int"
    first = [("a", day(1), 1), ("b", day(1), 2), ("a", day(2), 3)]
    writers.write_snapshot(spark.createDataFrame(first, schema), path, "month_start")
    untouched = sorted((tmp_path / "months" / "month_start=2024-01-02").glob("*.parquet"))
    for _ in range(2):
        rows = spark.createDataFrame([("a", day(1), 10), ("c", day(1), 4)], schema)
        writers.upsert(spark, path, rows, ["host", "month_start"], "month_start")
        stored = readers.read_parquet(spark, path).collect()
        assert sorted((r.host, r.month_start.day, r.hits) for r in stored) == [
            ("a", 1, 10),
            ("a", 2, 3),
            ("b", 1, 2),
            ("c", 1, 4),
        ]
    after = sorted((tmp_path / "months" / "month_start=2024-01-02").glob("*.parquet"))
    assert untouched == after


def test_delete_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, v string")
    doomed = spark.createDataFrame([(2,), (2,)], "id int")
    assert sorted(r.id for r in writers.delete_rows(df, doomed, ["id"]).collect()) == [1, 3]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for name in ("left_b", "right_b"):
        writers.bucket_write(rows, name, ["k"], 16, str(tmp_path / name))
    plain = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left, right = spark.table("left_b"), spark.table("right_b")
        joined = left.join(right.withColumnRenamed("v", "w"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.where("v = w").count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", plain)
    assert file_report(spark.table("left_b"), "buckets").first().num_files == 16


def test_sorted_files_and_their_report(spark, tmp_path):
    df = spark.range(4000).select((F.col("id") % 4).alias("a"), F.col("id").alias("b"))
    paths = {name: str(tmp_path / name) for name in "ab"}
    for name, path in paths.items():
        writers.sorted_write(df, path, name, 8)
    rows = {r.layout: r for r in compare_layouts(spark, paths).collect()}
    assert {r.num_files for r in rows.values()} == {8}
    assert {r.num_rows for r in rows.values()} == {4000}
    files = list((tmp_path / "a").glob("*.parquet"))
    assert sum(f.stat().st_size for f in files) == rows["a"].size_bytes
    assert_sorted = spark.read.parquet(str(files[0])).collect()
    assert [r.a for r in assert_sorted] == sorted(r.a for r in assert_sorted)


def test_sorted_files_come_from_ranges_that_are_sorted_apart(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(writers, "RANGE_ROWS", 700)
    monkeypatch.setattr(writers, "PACK_BYTES", 1)
    df = spark.range(6000).select(
        F.when(F.col("id") % 11 > 0, F.col("id") % 3).alias("few"),
        (F.col("id") * 7919 % 6000).cast("string").alias("many"),
        F.expr("CASE WHEN id % 5 > 0 THEN map('k', id) END").alias("m"),
        F.expr("timestamp_seconds(id)").alias("t"),
        F.expr("array(named_struct('x', id, 'y', null))").alias("s"),
    )
    df = df.union(df.where("few = 1"))
    rows = sorted(map(str, df.collect()))
    for name in ("few", "many"):
        path = tmp_path / name
        writers.sorted_write(df, str(path), name, 8)
        files = [spark.read.parquet(str(f)).collect() for f in path.glob("part-*")]
        assert len(files) == 8 and max(map(len, files)) - min(map(len, files)) <= 20
        for part in files:
            values = [(r[name] is not None, r[name]) for r in part]
            assert values == sorted(values)
        assert sorted(str(r) for part in files for r in part) == rows
    writers.sorted_write(df.where("few = 9"), str(tmp_path / "none"), "few", 8)
    none = spark.read.parquet(str(tmp_path / "none"))
    assert none.schema.fieldNames() == df.columns and none.count() == 0


def test_jdbc_options():
    options = writers.jdbc_options("jdbc:postgresql://db/x", "sessions", "u", "p")
    assert options["batchsize"] == "500" and options["dbtable"] == "sessions"
    assert options["driver"] == "org.postgresql.Driver"


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    assert new_path(spark, "x").startswith(folder)
    assert new_path(spark, "x") != new_path(spark, "x")


def test_a_temporary_folder_serves_only_where_none_is_set():
    class Context:
        folder = None
        master = "local[2]"

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = folder

    class Session:
        def __init__(self, folder):
            self.sparkContext, self.conf = Context(), {"spark.checkpoint.dir": folder}

    unset, cluster = Session(None), Session("hdfs:///shared")
    folder = shared_folder(unset)
    assert "daymark-" in folder and shared_folder(unset) == folder
    assert shared_folder(cluster) == "hdfs:///shared"
    assert cluster.sparkContext.folder == "hdfs:///shared"
    lost = Session(None)
    lost.sparkContext.master = "yarn"
    with pytest.raises(ValueError):
        shared_folder(lost)


def test_upsert_loads_an_empty_path_and_knows_null_keys(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "host string, month int, hits int"
    for hits in (1, 2):
        rows = spark.createDataFrame([("a", 1, hits), (None, 1, hits)], schema)
        writers.upsert(spark, path, rows, ["host", "month"], "month")
    stored = readers.read_parquet(spark, path).collect()
    assert sorted((str(r.host), r.hits) for r in stored) == [("None", 2), ("a", 2)]
    with pytest.raises(ValueError):
        writers.upsert(spark, path, rows, ["host"], "month")


def test_round_trip_of_snapshot_types(spark, tmp_path):
    df = spark.createDataFrame(
        [("h", [day(2), day(1)], day(2))], schemas.HOSTS
    )
    writers.write_snapshot(df, str(tmp_path / "t"), "c_date")
    back = schemas.as_schema(readers.read_parquet(spark, str(tmp_path / "t")), schemas.HOSTS)
    assertDataFrameEqual(back, df, ignoreNullable=True)
