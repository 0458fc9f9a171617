"""Batch and stream readers, and generated series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import as_column


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row and a given schema (inference would read the data twice)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_snapshot(
    spark: SparkSession, path: str, column: str, value: dt.date | str | int
) -> DataFrame:
    """One as-of snapshot of a partitioned table; other partitions are not listed or read."""
    as_of = F.lit(str(value) if isinstance(value, dt.date) else value)
    return spark.read.parquet(path).where(F.col(column) == as_of)


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """SQL over DataFrames, named in the text as ``{name}``, without global views."""
    return spark.sql(query, **frames)


def register_views(**frames: DataFrame) -> None:
    """Make DataFrames available to SQL under their names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def integer_series(spark: SparkSession, first: int, last: int, out: str = "n") -> DataFrame:
    """Integers ``first`` to ``last``, both included."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(out))


def date_series(
    spark: SparkSession, first: dt.date | str, last: dt.date | str, out: str = "day"
) -> DataFrame:
    """Days ``first`` to ``last``, both included."""
    start, end = F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")
    return spark.range(1).select(F.explode(F.sequence(start, end)).alias(out))


def parse_events(raw: DataFrame, schema: T.StructType, value: Column | str = "value") -> DataFrame:
    """Events from JSON text, as a Kafka source delivers it."""
    parsed = F.from_json(as_column(value).cast("string"), schema)
    return raw.select(parsed.alias("_event")).select("_event.*")


def kafka_events(
    spark: SparkSession, servers: str, topic: str, schema: T.StructType, **options: str
) -> DataFrame:
    """Event stream from a Kafka topic with JSON values (needs the Kafka connector)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**options)
        .load()
    )
    return parse_events(raw, schema)


def file_events(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Event stream from Parquet files that appear in a folder."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)
