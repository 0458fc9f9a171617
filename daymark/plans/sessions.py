"""Sessions by visitor and host, in batch and as a stream."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.sessions import average_events, average_events_by_host, sessionize
from ..session import new_path
from ..sources.readers import file_events
from ..streaming.arrivals import BATCH, ArrivalLog, record_arrivals
from ..streaming.sessions import SessionTable, run_sessions, stream_sessions
from .inputs import table, web_events

# Parameters of the session job. The data is sparse, hence the long gap.
GAP = dt.timedelta(hours=6)
DELAY = dt.timedelta(minutes=10)
METRIC, PATTERN = "avg_session_events_pattern", "%i%"
HOSTS = ["click", "error", "purchase"]
# Rows more than this behind the newest row of the runs before are late.
LATENESS = dt.timedelta(hours=12)
KEYS = ["ip", "host"]


def sessions(spark: SparkSession, folder: str) -> DataFrame:
    """All sessions."""
    return sessionize(web_events(spark, folder), "ts", KEYS, GAP)


def pattern_average(spark: SparkSession, folder: str) -> DataFrame:
    """Average events per session over hosts like a pattern."""
    return average_events(sessions(spark, folder), F.col("host").like(PATTERN), METRIC)


def host_averages(spark: SparkSession, folder: str) -> DataFrame:
    """Average events per session of chosen hosts."""
    return average_events_by_host(sessions(spark, folder), HOSTS)


def _run_stream(spark: SparkSession, folder: str) -> SessionTable:
    """Work off the event files with the streaming job; its table."""
    schema = table(spark, folder, "events").schema
    events = file_events(spark, folder, schema, "events.parquet").select(
        "ts", F.col("user_id").cast("string").alias("ip"), F.col("event_type").alias("host")
    )
    base = new_path(spark, "sessions")
    stored = SessionTable(f"{base}/tables", patterns={METRIC: PATTERN}, hosts=HOSTS)
    query = run_sessions(
        stream_sessions(events, "ts", KEYS, GAP, DELAY),
        stored,
        f"{base}/checkpoint",
        available_now=True,
    )
    query.awaitTermination()
    return stored


def sessions_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions the streaming job has closed when it has read all events."""
    stored = _run_stream(spark, folder)
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")}
    return stored.read_sessions(spark).withColumns(times)


def stream_host_averages(spark: SparkSession, folder: str) -> DataFrame:
    """Averages the streaming job keeps per chosen host, over closed sessions."""
    stored = _run_stream(spark, folder)
    return stored.host_averages(stored.read_totals(spark))


def stream_pattern_average(spark: SparkSession, folder: str) -> DataFrame:
    """Average the streaming job keeps for hosts like a pattern, over closed sessions."""
    stored = _run_stream(spark, folder)
    return stored.pattern_averages(stored.read_totals(spark))


def stream_host_totals_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions and events per host, from the stored sessions after two runs of the streaming job
    over one folder, the second with a new checkpoint, and a compaction."""
    schema = table(spark, folder, "events").schema
    base = new_path(spark, "sessions")
    for run in ("first", "second"):
        events = file_events(spark, folder, schema, "events.parquet").select(
            "ts", F.col("user_id").cast("string").alias("ip"), F.col("event_type").alias("host")
        )
        stored = SessionTable(f"{base}/tables")
        closed = stream_sessions(events, "ts", KEYS, GAP, DELAY)
        run_sessions(closed, stored, f"{base}/{run}", available_now=True).awaitTermination()
    stored.compact(spark)
    sums = stored.read_sessions(spark).groupBy("host").agg(
        F.count(F.lit(1)).alias("stored_sessions"), F.sum("events_in_session").alias("stored_events")
    )
    return stored.read_totals(spark).join(sums, "host")


def late_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events that came late, the run that brought them, and the counts over all runs.

    The streaming job runs once for every week in which events arrive and reads what has come
    since its last run. An event arrives as many hours after its time as its value says.
    """
    events = table(spark, folder, "events")
    arrival = F.expr("ts + make_dt_interval(0, CAST(floor(coalesce(value, 0)) AS INT), 0, 0)")
    arriving = events.withColumn("_week", F.date_trunc("week", arrival).cast("date"))
    base = new_path(spark, "arrivals")
    log = ArrivalLog(f"{base}/log", "ts", LATENESS)
    # As many rows as the calendar has weeks.
    for week in sorted(r["_week"] for r in arriving.select("_week").distinct().toLocalIterator()):
        arrived = arriving.where(F.col("_week") == F.lit(week)).drop("_week")
        arrived.write.mode("append").parquet(f"{base}/source")
        stream = file_events(spark, f"{base}/source", events.schema)
        record_arrivals(stream, log, f"{base}/checkpoint", available_now=True).awaitTermination()
    counts = log.totals(spark).first()
    return log.late_rows(spark, events.schema).select(
        "event_id", "ts", "user_id", "event_type", BATCH,
        F.lit(counts["late_count"]).cast("long").alias("late_count"),
        F.lit(counts["row_count"]).cast("long").alias("row_count"),
    )


QUERIES = {
    "late_events": late_events,
    "sessions": sessions,
    "avg_session_events_pattern": pattern_average,
    "avg_session_events_per_host": host_averages,
    "sessions_stream": sessions_stream,
    "stream_avg_events_pattern": stream_pattern_average,
    "stream_avg_events_per_host": stream_host_averages,
    "stream_host_totals_compacted": stream_host_totals_compacted,
}

_SESSIONS = """
    numbered AS (
      SELECT CAST(user_id AS VARCHAR) AS ip, event_type AS host, ts,
             count(*) FILTER (WHERE apart) OVER (
               PARTITION BY user_id, event_type ORDER BY ts, event_id) AS session
      FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id)
                      > INTERVAL 6 HOUR AS apart FROM events)),
    all_sessions AS (
      SELECT min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end,
             ip, host, count(*) AS events_in_session
      FROM numbered GROUP BY ip, host, session),
    closed AS (
      SELECT * FROM all_sessions WHERE session_end <= (
        SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events))
"""


def _per_host(source: str) -> str:
    return f"""
        WITH {_SESSIONS}
        SELECT host, avg(events_in_session) AS avg_events_per_session FROM {source}
        WHERE host IN ('click', 'error', 'purchase') GROUP BY host
    """


def _pattern(source: str) -> str:
    return f"""
        WITH {_SESSIONS}
        SELECT 'avg_session_events_pattern' AS metric,
               avg(events_in_session) AS avg_events_per_session
        FROM {source} WHERE host LIKE '%i%'
    """


ORACLES = {
    "late_events": """
        WITH arriving AS (
          SELECT *, date_trunc('week', ts + to_hours(CAST(floor(coalesce(value, 0)) AS INTEGER))) AS week
          FROM events),
        weeks AS (
          SELECT week, row_number() OVER (ORDER BY week) - 1 AS arrival_batch,
                 max(max(ts)) OVER (ORDER BY week ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS high
          FROM arriving GROUP BY week),
        late AS (
          SELECT event_id, ts, user_id, event_type, arrival_batch
          FROM arriving JOIN weeks USING (week) WHERE ts < high - INTERVAL 12 HOUR)
        SELECT *, count(*) OVER () AS late_count, (SELECT count(*) FROM events) AS row_count FROM late
    """,
    "sessions": f"WITH {_SESSIONS} SELECT * FROM all_sessions",
    "avg_session_events_pattern": _pattern("all_sessions"),
    "avg_session_events_per_host": _per_host("all_sessions"),
    "sessions_stream": f"WITH {_SESSIONS} SELECT * FROM closed",
    "stream_avg_events_pattern": _pattern("closed"),
    "stream_avg_events_per_host": _per_host("closed"),
    "stream_host_totals_compacted": f"""
        WITH {_SESSIONS}
        SELECT host, count(*) AS sessions, CAST(sum(events_in_session) AS BIGINT) AS events,
               count(*) AS stored_sessions, CAST(sum(events_in_session) AS BIGINT) AS stored_events
        FROM closed GROUP BY host
    """,
}
