"""Arriving rows kept in batches, with rows that come too late in a part of their own."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..sources.writers import table_exists
from .sessions import CHECKPOINT_INTERVAL, _duration, checkpoint_run

BATCH, LATE = "arrival_batch", "arrival_late"
_LINE = "row_count long, late_count long, high string"


@dataclass
class ArrivalLog:
    """Every row of a stream, kept once, with the late ones apart and counted.

    A row is late if its time is more than ``delay`` behind the greatest time of all batches
    before its own; rows of the same batch never make each other late, and rows without a time
    are never late. A batch is written in one pass, split by lateness, into a folder of its run
    and number. One commit line follows, which holds the rows, the late rows and the greatest
    time of the run so far; it comes from the batch's own files and the line before, so counts
    are exact however long the stream has run and a batch costs its own rows only. Readers see
    committed batches. A batch that runs again is known by its line and changes nothing; one
    that ended before its line is written anew.
    """

    folder: str
    ts: str
    delay: dt.timedelta
    run: str = "0"

    def _rows_path(self) -> str:
        return f"{self.folder}/rows/run={self.run}"

    def _line_path(self, batch: int) -> str:
        return f"{self.folder}/lines/run={self.run}/{BATCH}={batch}"

    def _line(self, spark: SparkSession, batch: int) -> DataFrame:
        return spark.read.schema(_LINE).parquet(self._line_path(batch))

    def write_batch(self, rows: DataFrame, batch: int) -> None:
        """Sink of one micro-batch; batches of a run are numbered from 0 without gaps."""
        if {BATCH, LATE} & set(rows.columns):
            raise ValueError(f"{BATCH!r} and {LATE!r} are names of the log")
        spark = rows.sparkSession
        if table_exists(spark, self._line_path(batch)):
            return
        kind = rows.schema[self.ts].dataType
        high = self._line(spark, batch - 1).first()["high"] if batch else None
        late = F.col(self.ts) < F.lit(high).cast(kind) - F.lit(self.delay)
        path = f"{self._rows_path()}/{BATCH}={batch}"
        (
            rows.withColumn(LATE, F.coalesce(late, F.lit(False)).cast("int"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy(LATE)
            .parquet(path)
        )
        stored = spark.read.schema(_with(rows.schema, late=True)).parquet(path)
        # Times as text keep all their digits and sort like times.
        line = stored.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(LATE) == 1).alias("late_count"),
            F.max(self.ts).cast("string").alias("high"),
        )
        if batch:
            line = line.unionByName(self._line(spark, batch - 1)).agg(
                F.sum("row_count").alias("row_count"),
                F.sum("late_count").alias("late_count"),
                F.max(F.col("high").cast(kind)).cast("string").alias("high"),
            )
        line.coalesce(1).write.mode("errorifexists").parquet(self._line_path(batch))

    def totals(self, spark: SparkSession) -> DataFrame:
        """One row for the committed batches: arrival_batch (the last), row_count, late_count, high."""
        lines = spark.read.schema(f"{_LINE}, {BATCH} long").parquet(f"{self.folder}/lines/run={self.run}")
        return lines.orderBy(F.desc(BATCH)).limit(1).select(BATCH, "row_count", "late_count", "high")

    def _read(self, spark: SparkSession, schema: T.StructType, late: int) -> DataFrame:
        last = self.totals(spark).first()[BATCH]
        stored = spark.read.schema(_with(schema, batch=True, late=True)).parquet(self._rows_path())
        return stored.where((F.col(BATCH) <= last) & (F.col(LATE) == late)).drop(LATE)

    def late_rows(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The late rows with the number of their batch; only their files are read."""
        return self._read(spark, schema, 1)

    def rows_in_time(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The other rows with the number of their batch."""
        return self._read(spark, schema, 0)


def _with(schema: T.StructType, batch: bool = False, late: bool = False) -> T.StructType:
    added = [T.StructField(BATCH, T.LongType())] * batch + [T.StructField(LATE, T.IntegerType())] * late
    return T.StructType(schema.fields + added)


def record_arrivals(
    events: DataFrame,
    log: ArrivalLog,
    checkpoint: str,
    interval: dt.timedelta = CHECKPOINT_INTERVAL,
    available_now: bool = False,
) -> StreamingQuery:
    """Start the query that fills the log; see ``run_sessions`` for the parameters."""
    log.run = checkpoint_run(events.sparkSession, checkpoint)
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(log.write_batch)
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=_duration(interval)).start()
