"""The session stream against the batch operator, its sinks, and late rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from daymark.operators.sessions import sessionize
from daymark.plans.inputs import web_events
from daymark.sources.readers import file_events
from daymark.sources.schemas import STREAM_EVENTS
from daymark.streaming.sessions import (
    SessionTable,
    checkpoint_run,
    dropped_rows,
    run_sessions,
    stream_daily_averages,
    stream_sessions,
)

KEYS, TS = ["ip", "host"], "window_timestamp"
GAP = dt.timedelta(hours=6)


@pytest.fixture(scope="module")
def event_folder(spark, sf_dir, tmp_path_factory):
    """The events as four files in time order."""
    folder = str(tmp_path_factory.mktemp("events"))
    events = web_events(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias(TS), "ip", "host"
    )
    for first, last in ((1, 8), (8, 15), (15, 22), (22, 31)):
        part = events.where(F.dayofmonth(TS).between(first, last - 1))
        part.coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, folder):
    return file_events(spark, folder, STREAM_EVENTS, files_per_batch=1)


def run(spark, folder, base, sessions, **options):
    table = SessionTable(f"{base}/tables", **options)
    query = run_sessions(sessions, table, f"{base}/checkpoint", available_now=True)
    query.awaitTermination()
    assert query.exception() is None
    return table, query


def test_stream_gives_the_closed_batch_sessions(spark, event_folder, tmp_path):
    seen = []
    table, query = run(
        spark,
        event_folder,
        tmp_path,
        stream_sessions(stream(spark, event_folder), TS, KEYS, GAP),
        patterns={"with_i": "%i%", "all": "%", "none": "zzz"},
        hosts=["click", "error"],
        outputs=[lambda name, df, batch: seen.append((name, batch, df.count()))],
    )
    assert dropped_rows(query) == 0
    # The file reader gives files in order of time of writing, one per batch.
    batches = query.lastProgress["batchId"]
    assert batches >= 4

    events = spark.read.schema(STREAM_EVENTS).parquet(event_folder)
    last = events.agg(F.date_trunc("millisecond", F.max(TS))).scalar()
    expected = sessionize(events, TS, KEYS, GAP).where(F.col("session_end") <= last)
    stored = table.read_sessions(spark)
    assertDataFrameEqual(stored, expected.select(stored.columns), ignoreNullable=True)

    totals = table.read_totals(spark)
    by_host = {r.host: r for r in totals.collect()}
    sums = stored.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum("events_in_session").alias("e")
    )
    for r in sums.collect():
        assert (by_host[r.host].sessions, by_host[r.host].events) == (r.n, r.e)
    averages = {r.host: r.avg_events_per_session for r in table.host_averages(totals).collect()}
    assert averages == {h: by_host[h].events / by_host[h].sessions for h in ("click", "error")}
    metrics = {r.metric: r.avg_events_per_session for r in table.pattern_averages(totals).collect()}
    assert set(metrics) == {"with_i", "all"}
    assert metrics["all"] == stored.agg(F.avg("events_in_session")).first()[0]

    # A batch that runs again changes nothing, whatever it brings.
    again = spark.read.schema(stored.schema).parquet(table.sessions_path(batches))
    table.write_batch(spark.createDataFrame(again.collect() * 2, again.schema), batches)
    stored = table.read_sessions(spark)
    assertDataFrameEqual(stored, expected.select(stored.columns), ignoreNullable=True)
    repeated = {r.host: (r.sessions, r.events) for r in table.read_totals(spark).collect()}
    assert repeated == {h: (r.sessions, r.events) for h, r in by_host.items()}
    assert {name for name, _, _ in seen} == {"sessions", "averages", "host_averages"}

    # Compaction changes the folders and not the rows; the next batch goes on from it.
    unused = table.compact(spark)
    assert len(unused) == 2 * (batches + 1) and len(table.commits(spark)) == 1
    assertDataFrameEqual(table.read_sessions(spark), expected.select(stored.columns), ignoreNullable=True)
    table.write_batch(stored.where("host = 'click'").limit(1), batches + 1)
    assert table.read_sessions(spark).count() == expected.count() + 1
    after = {r.host: r.sessions for r in table.read_totals(spark).collect()}
    assert after == {h: r.sessions + (h == "click") for h, r in by_host.items()}
    assert table.compact(spark) and table.read_sessions(spark).count() == expected.count() + 1


SESSION = "session_start timestamp, session_end timestamp, ip string, host string, events_in_session long"


def batch(spark, *events):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(t, t, "i", "h", n) for n in events], SESSION)


def seen_by_readers(spark, table):
    totals = table.read_totals(spark).first()
    rows = [r.events_in_session for r in table.read_sessions(spark).collect()]
    assert (totals.sessions, totals.events) == (len(rows), sum(rows))
    return sorted(rows)


def test_a_batch_that_ends_between_its_writes_is_not_seen(spark, tmp_path, monkeypatch):
    table = SessionTable(str(tmp_path / "t"), run="a")
    table.write_batch(batch(spark, 1, 2), 0)
    for step in ("_add_totals", "_commit"):
        with monkeypatch.context() as m:
            m.setattr(SessionTable, step, lambda *args: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                table.write_batch(batch(spark, 3), 1)
        assert seen_by_readers(spark, table) == [1, 2]
    table.write_batch(batch(spark, 3), 1)
    assert seen_by_readers(spark, table) == [1, 2, 3]


def test_a_new_run_neither_overwrites_nor_mixes(spark, tmp_path):
    folder = str(tmp_path / "t")
    old = SessionTable(folder, run="a")
    for number, events in enumerate([(1, 2), (3,)]):
        old.write_batch(batch(spark, *events), number)
    new = SessionTable(folder, run="b")
    new.write_batch(batch(spark, 10), 0)
    assert seen_by_readers(spark, new) == [10]
    assert spark.read.schema(SESSION).parquet(old.sessions_path(0)).count() == 2  # still there
    new.write_batch(batch(spark, 11), 1)
    assert seen_by_readers(spark, new) == [10, 11]
    more = SessionTable(folder, run="c", continues=True)
    more.write_batch(batch(spark, 12), 0)
    assert seen_by_readers(spark, more) == [10, 11, 12]


def test_a_checkpoint_keeps_its_run(spark, tmp_path):
    first = checkpoint_run(spark, str(tmp_path / "one"))
    assert checkpoint_run(spark, str(tmp_path / "one")) == first != checkpoint_run(spark, str(tmp_path / "two"))


def test_no_commit_is_an_error_for_readers(spark, tmp_path):
    for read in (SessionTable.read_totals, SessionTable.read_sessions):
        with pytest.raises(FileNotFoundError):
            read(SessionTable(str(tmp_path / "t")), spark)


def test_late_rows_are_counted(spark, tmp_path):
    folder, t0 = str(tmp_path / "in"), dt.datetime(2024, 1, 1, 12)
    # Spark drops rows behind the watermark of the batch before, hence one batch more.
    for hours in (0, 48, 49, 1):
        spark.createDataFrame(
            [(t0 + dt.timedelta(hours=hours), "i", "h")], STREAM_EVENTS
        ).coalesce(1).write.mode("append").parquet(folder)
    for delay, dropped, closed in ((0, 1, 2), (72, 0, 0)):
        sessions = stream_sessions(
            stream(spark, folder), TS, KEYS, dt.timedelta(minutes=5), dt.timedelta(hours=delay)
        )
        table, query = run(spark, folder, tmp_path / f"delay{delay}", sessions)
        assert dropped_rows(query) == dropped
        assert table.read_sessions(spark).count() == closed


def test_daily_averages_stream(spark, event_folder, tmp_path):
    out = str(tmp_path / "out")
    averages = stream_daily_averages(stream(spark, event_folder), TS, KEYS, ["host"], GAP)
    query = (
        averages.writeStream.outputMode("append")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .format("parquet")
        .trigger(availableNow=True)
        .start(out)
    )
    query.awaitTermination()
    # A session belongs to the day of the last instant before its end.
    events = spark.read.schema(STREAM_EVENTS).parquet(event_folder)
    day = (F.col("session_end") - F.expr("interval 1 microsecond")).cast("date")
    expected = (
        sessionize(events, TS, KEYS, GAP)
        .groupBy(day.alias("day"), "host")
        .agg(F.avg("events_in_session").alias("avg_events_per_session"))
    )
    stored = spark.read.parquet(out)
    assert stored.count() > 100
    joined = stored.join(expected, ["day", "host", "avg_events_per_session"], "left_anti")
    assert joined.count() == 0
