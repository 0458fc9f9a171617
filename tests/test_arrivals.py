"""The log of arriving rows and the keyed JDBC write."""

import datetime as dt

import duckdb
import pytest

from daymark.sources import writers
from daymark.streaming import sinks
from daymark.streaming.arrivals import ArrivalLog, record_arrivals

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, at timestamp_ntz"


def rows(spark, *pairs):
    data = [(i, None if h is None else T0 + dt.timedelta(hours=h)) for i, h in pairs]
    return spark.createDataFrame(data, SCHEMA)


def state(spark, log, schema):
    t = log.totals(spark).first()
    late = sorted((r["id"], r["arrival_batch"]) for r in log.late_rows(spark, schema).collect())
    kept = sorted(r["id"] for r in log.rows_in_time(spark, schema).collect())
    assert (t["row_count"], t["late_count"]) == (len(late) + len(kept), len(late))
    return late, kept


def test_late_rows_are_kept_and_counted(spark, tmp_path):
    log = ArrivalLog(str(tmp_path / "log"), "at", dt.timedelta(hours=2), run="a")
    schema = rows(spark).schema
    log.write_batch(rows(spark, (1, 10), (2, 0), (3, None)), 0)  # no batch before, no late rows
    assert state(spark, log, schema) == ([], [1, 2, 3])
    # Exactly at the limit is in time; the batch's own newest row makes none of its rows late.
    log.write_batch(rows(spark, (4, 8), (5, 7), (6, 50), (7, None)), 1)
    assert state(spark, log, schema) == ([(5, 1)], [1, 2, 3, 4, 6, 7])
    log.write_batch(rows(spark), 2)
    # A batch without newer rows lowers nothing.
    log.write_batch(rows(spark, (8, 47), (9, 48)), 3)
    expected = ([(5, 1), (8, 3)], [1, 2, 3, 4, 6, 7, 9])
    assert state(spark, log, schema) == expected
    log.write_batch(rows(spark, (10, 0)), 3)  # known already
    assert state(spark, log, schema) == expected
    # Rows without a commit line are not seen, and are replaced when the batch runs again.
    rows(spark, (11, 0), (12, 60)).write.parquet(f"{tmp_path}/log/rows/run=a/arrival_batch=4/arrival_late=1")
    assert state(spark, log, schema) == expected
    log.write_batch(rows(spark, (12, 60)), 4)
    assert state(spark, log, schema) == (expected[0], [*expected[1], 12])


def test_names_of_the_log_are_refused(spark, tmp_path):
    log = ArrivalLog(str(tmp_path / "log"), "at", dt.timedelta(0))
    with pytest.raises(ValueError):
        log.write_batch(rows(spark, (1, 1)).withColumnRenamed("id", "arrival_batch"), 0)


def test_runs_of_the_stream_go_on(spark, tmp_path):
    source, log = str(tmp_path / "in"), ArrivalLog(str(tmp_path / "log"), "at", dt.timedelta(hours=1))
    for part in ([(1, 5)], [(2, 1), (3, 9)], [(4, 8), (5, 7)]):
        rows(spark, *part).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows(spark).schema).parquet(source)
        query = record_arrivals(stream, log, str(tmp_path / "cp"), available_now=True)
        query.awaitTermination()
        assert query.exception() is None
    assert state(spark, log, rows(spark).schema) == ([(2, 1), (5, 2)], [1, 3, 4])


def test_statement():
    text = writers.upsert_statement("s", "s_staging", ["a", 'b"c', "n"], ["a"])
    assert text == (
        'INSERT INTO s ("a", "b""c", "n") SELECT DISTINCT "a", "b""c", "n" FROM s_staging WHERE TRUE '
        'ON CONFLICT ("a") DO UPDATE SET "b""c" = EXCLUDED."b""c", "n" = EXCLUDED."n"'
    )
    assert writers.upsert_statement("s", "t", ["a"], ["a"]).endswith('ON CONFLICT ("a") DO NOTHING')
    for keys in ([], ["z"]):
        with pytest.raises(ValueError):
            writers.upsert_statement("s", "t", ["a"], keys)


def test_a_repeated_write_changes_nothing(spark, monkeypatch):
    """The calls in their order; the statements run in a database within the process."""
    base, calls = duckdb.connect(), []
    base.execute('CREATE TABLE h (host VARCHAR PRIMARY KEY, avg_events_per_session DOUBLE)')

    def write(df, options, mode):
        calls.append((options["dbtable"], mode))
        staged = df.toPandas()
        base.execute(f'CREATE OR REPLACE TABLE {options["dbtable"]} AS SELECT * FROM staged UNION ALL SELECT * FROM staged')

    def execute(statement):
        calls.append(statement.split()[0])
        base.execute(statement)

    monkeypatch.setattr(writers, "jdbc_write", write)
    output = sinks.jdbc_output({"host_averages": {"dbtable": "h"}}, execute)
    first = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "host string, avg_events_per_session double")
    second = spark.createDataFrame([("y", 3.0), ("z", 4.0)], first.schema)
    for df in (first, second, second):
        output("host_averages", df, 0)
    output("sessions", first, 0)  # no target
    assert calls == [("h_staging", "overwrite"), "INSERT"] * 3
    assert base.execute("SELECT * FROM h ORDER BY host").fetchall() == [("x", 1.0), ("y", 3.0), ("z", 4.0)]
