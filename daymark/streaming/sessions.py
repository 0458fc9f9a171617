"""Sessions over an event stream, written with running averages by one query."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.conditions import ratio
from ..sources.writers import table_exists

# Defaults of the session job.
SESSION_GAP = dt.timedelta(minutes=5)
CHECKPOINT_INTERVAL = dt.timedelta(seconds=60)


def _duration(span: dt.timedelta) -> str:
    return f"{span // dt.timedelta(milliseconds=1)} milliseconds"


def _session_counts(
    events: DataFrame, ts: str, keys: Sequence[str], gap: dt.timedelta, delay: dt.timedelta
) -> DataFrame:
    timed = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, _duration(delay))
    window = F.session_window(ts, _duration(gap)).alias("_session")
    return timed.groupBy(window, *keys).agg(F.count(F.lit(1)).alias("events_in_session"))


def stream_sessions(
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    gap: dt.timedelta = SESSION_GAP,
    delay: dt.timedelta = dt.timedelta(0),
) -> DataFrame:
    """Sessions per key, from a stream or a table.

    The watermark follows event time by ``delay``, which must exceed the disorder of the
    source: later rows are dropped, and the query's progress counts them. Events of one key
    that are close together are merged inside each task before the shuffle when
    ``spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition`` is on
    (daymark.session sets it).
    """
    return _session_counts(events, ts, keys, gap, delay).select(
        F.col("_session.start").alias("session_start"),
        F.col("_session.end").alias("session_end"),
        *keys,
        "events_in_session",
    )


def stream_daily_averages(
    events: DataFrame,
    ts: str,
    keys: Sequence[str],
    by: Sequence[str],
    gap: dt.timedelta = SESSION_GAP,
    delay: dt.timedelta = dt.timedelta(0),
) -> DataFrame:
    """Average events per session by ``by`` and the day on which the sessions ended.

    The day window takes its time from the session window, which carries the watermark on,
    so append mode can close a day.
    """
    day = F.window(F.window_time("_session"), "1 day")
    return (
        _session_counts(events, ts, keys, gap, delay)
        .groupBy(day.alias("_day"), *by)
        .agg(F.avg("events_in_session").alias("avg_events_per_session"))
        .select(F.col("_day.start").cast("date").alias("day"), *by, "avg_events_per_session")
    )


def checkpoint_run(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that a checkpoint folder belongs to, kept in it.

    A query that goes on from its checkpoint keeps its id; a new checkpoint is a new run, whose
    batch numbers begin again at 0.
    """
    path = f"{checkpoint}/run"
    if not table_exists(spark, path):
        named = spark.createDataFrame([(uuid.uuid4().hex,)], "run string")
        named.coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("run string").parquet(path).first()["run"]


@dataclass
class SessionTable:
    """Where the session query keeps its tables, and the averages it maintains.

    A batch writes its sessions, then the sessions and events of every host so far (``totals``),
    each into a folder of its run and number, and then one file to the log of commits. Readers
    follow the log, so they see sessions and totals of the same batches: those of the last
    commit, or of the one before it if a batch ended between its writes. A batch that runs
    again is known by its commit and changes nothing.

    Each batch adds its sessions to the totals of the commit before, so it costs its own
    sessions plus one row per host, however long the stream has run. A new run, one with a new
    checkpoint, starts a table of its own, which readers see from its first commit on; with
    ``continues`` it goes on from what is there, for sources that go on as well.
    :meth:`compact` puts the batches so far into one.
    """

    folder: str
    host: str = "host"
    patterns: Mapping[str, str] = field(default_factory=dict)
    hosts: Sequence[str] = ()
    outputs: Sequence[Callable[[str, DataFrame, int], None]] = ()
    run: str = "0"
    continues: bool = False

    def _part(self, kind: str, run: str, batch: int) -> str:
        return f"{self.folder}/{kind}/run={run}/batch={batch}"

    def sessions_path(self, batch: int) -> str:
        return self._part("sessions", self.run, batch)

    def commits(self, spark: SparkSession) -> list[tuple[int, str, int]]:
        """(number, run, batch) of the commits that make up the table, in order.

        These are the last one that starts a table and all after it; compaction keeps them few.
        """
        if not table_exists(spark, f"{self.folder}/commits"):
            return []
        log = spark.read.schema("run string, batch long, starts boolean, n long").parquet(f"{self.folder}/commits")
        lines = sorted((r["n"], r["run"], r["batch"], r["starts"]) for r in log.toLocalIterator())
        first = max((i for i, line in enumerate(lines) if line[3]), default=0)
        return [line[:3] for line in lines[first:]]

    def _commit(self, spark: SparkSession, number: int, run: str, batch: int, starts: bool) -> None:
        line = spark.createDataFrame([(run, batch, starts)], "run string, batch long, starts boolean")
        line.coalesce(1).write.mode("errorifexists").parquet(f"{self.folder}/commits/n={number}")

    def write_batch(self, sessions: DataFrame, batch: int) -> None:
        """Sink of one micro-batch."""
        spark = sessions.sparkSession
        known = self.commits(spark)
        if (self.run, batch) not in {line[1:] for line in known}:
            path = self.sessions_path(batch)
            sessions.write.mode("overwrite").parquet(path)
            goes_on = bool(known) and (self.continues or known[-1][1] == self.run or self._compacted(known[-1]))
            before = known[-1] if goes_on else None
            self._add_totals(spark.read.schema(sessions.schema).parquet(path), batch, before)
            self._commit(spark, known[-1][0] + 1 if known else 1, self.run, batch, not goes_on)
        stored = spark.read.schema(sessions.schema).parquet(self.sessions_path(batch))
        totals = self.read_totals(spark)
        for output in self.outputs:
            output("sessions", stored, batch)
            output("averages", self.pattern_averages(totals), batch)
            output("host_averages", self.host_averages(totals), batch)

    def _compacted(self, line: tuple[int, str, int]) -> bool:
        """Whether a commit is a compaction of this run's batches."""
        return line[1] == f"{self.run}-compact"

    def _add_totals(self, sessions: DataFrame, batch: int, before: tuple[int, str, int] | None) -> None:
        spark = sessions.sparkSession
        added = sessions.groupBy(self.host).agg(
            F.count(F.lit(1)).alias("sessions"), F.sum("events_in_session").alias("events")
        )
        if before:
            added = (
                self._totals(spark, *before[1:])
                .unionByName(added)
                .groupBy(self.host)
                .agg(F.sum("sessions").alias("sessions"), F.sum("events").alias("events"))
            )
        added.write.mode("overwrite").parquet(self._part("totals", self.run, batch))

    def _totals(self, spark: SparkSession, run: str, batch: int) -> DataFrame:
        schema = f"`{self.host}` string, sessions bigint, events bigint"
        return spark.read.schema(schema).parquet(self._part("totals", run, batch))

    def read_totals(self, spark: SparkSession) -> DataFrame:
        """Sessions and events per host up to the last commit."""
        known = self.commits(spark)
        if not known:
            raise FileNotFoundError(f"{self.folder} has no committed batch")
        return self._totals(spark, *known[-1][1:])

    def read_sessions(self, spark: SparkSession) -> DataFrame:
        """The sessions of all committed batches."""
        paths = [self._part("sessions", run, batch) for _, run, batch in self.commits(spark)]
        if not paths:
            raise FileNotFoundError(f"{self.folder} has no committed batch")
        return spark.read.parquet(*paths)

    def compact(self, spark: SparkSession) -> list[str]:
        """Put the sessions of all committed batches into one folder; returns the folders that
        no commit needs any more, for the owner to drop once no reader uses them.

        Run it between batches. The commit of the result starts the table anew, so readers see
        the old folders or the new one.
        """
        known = self.commits(spark)
        if len(known) < 2:
            return []
        number, run = known[-1][0] + 1, f"{self.run}-compact"
        self.read_sessions(spark).hint("rebalance").write.mode("overwrite").parquet(self._part("sessions", run, number))
        self.read_totals(spark).write.mode("overwrite").parquet(self._part("totals", run, number))
        self._commit(spark, number, run, number, True)
        return [self._part(kind, r, b) for _, r, b in known for kind in ("sessions", "totals")]

    def pattern_averages(self, totals: DataFrame) -> DataFrame:
        """One row per metric: average events per session of hosts like its pattern."""
        choices = [
            F.when(F.col(self.host).like(pattern), F.lit(metric))
            for metric, pattern in self.patterns.items()
        ]
        metric = F.explode(F.array_compact(F.array(*choices).cast("array<string>")))
        return self._averages(totals.select("*", metric.alias("metric")), F.col("metric"))

    def host_averages(self, totals: DataFrame) -> DataFrame:
        """Average events per session of each listed host."""
        return self._averages(totals.where(F.col(self.host).isin(*self.hosts)), F.col(self.host))

    @staticmethod
    def _averages(totals: DataFrame, by: Column) -> DataFrame:
        average = ratio(F.sum("events"), F.sum("sessions"))
        return totals.groupBy(by).agg(average.alias("avg_events_per_session"))


def run_sessions(
    sessions: DataFrame,
    table: SessionTable,
    checkpoint: str,
    interval: dt.timedelta = CHECKPOINT_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the one query that fills the session table and all its averages.

    ``available_now`` works off what is there and stops; otherwise a batch starts every
    ``interval``. The checkpoint folder must be shared storage; the id of its run goes into the
    paths of the batches (:func:`checkpoint_run`).
    """
    table.run = checkpoint_run(sessions.sparkSession, checkpoint)
    writer = (
        sessions.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(table.write_batch)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=_duration(interval)).start()


def dropped_rows(query: StreamingQuery) -> int:
    """Rows the query has dropped as too late."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
