"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame

from daymark.session import new_path

#: Bytes of rows that pass between a task and its Python worker at once, unless a single row has more.
BATCH_BYTES = 8_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written to the shared folder and read again.

    This cuts the lineage: what is read later does not depend on the executors that made it.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(work):
    """``work`` on a task's batches, after which the Python worker gives back its unused memory.

    Workers live on from stage to stage, and each would keep the most that any task has used.
    """

    def done(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return done


def ship(spark) -> None:
    """Send this package to the executors once, for clusters where it is not installed.

    Batches are held to ``BATCH_BYTES`` unless the session has a limit of its own: tasks and
    workers keep whole batches outside the heap, and Spark's default lets them have 64 MB.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if limit not in spark.conf.getAll:
        spark.conf.set(limit, str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_daymark_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    target = Path(tempfile.mkdtemp(prefix="daymark-code-")) / "daymark.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    context._daymark_shipped = True
