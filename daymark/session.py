"""Session set-up for jobs, tests and the benchmark."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Adaptive execution picks partition counts and splits skewed join sides at run time; the
# high initial count leaves it something to coalesce. Sessions are merged inside a task
# before the shuffle. UTC keeps days and session borders the same on every machine. Recording
# the Python call site of every expression doubles the time to build a plan.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(
    app: str = "daymark", master: str | None = None, **settings: str
) -> SparkSession:
    """Session with the settings above; the master comes from spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Where that is unset, a local master gets a temporary folder; on a cluster, where each
    machine would write to its own disk, this is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="daymark-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A path for one run's output inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, which outlives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def shared(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a result for several actions and release it after them.

    Blocks that do not fit in memory go to disk, and lost ones are computed again.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
