"""JDBC outputs of the session stream."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from ..sources.writers import jdbc_upsert, jdbc_write

#: What tells the rows of each result apart.
KEYS = {
    "sessions": ["ip", "host", "session_start"],
    "averages": ["metric"],
    "host_averages": ["host"],
}


def jdbc_output(
    targets: Mapping[str, Mapping[str, str]],
    execute: Callable[[str], object] | None = None,
    keys: Mapping[str, list[str]] = KEYS,
) -> Callable[[str, DataFrame, int], None]:
    """An output for ``SessionTable.outputs``; ``targets`` maps result names to options.

    With ``execute`` (see ``jdbc_upsert``) all results are put in by their keys: a batch that
    runs again changes nothing, and readers never meet an emptied table. Without it sessions are
    appended with their batch number, so that a batch written twice after a failure can be
    recognised in the database (key: batch, ip, host, start), and averages have one row per
    metric or host and replace the table's rows.
    """

    def write(name: str, df: DataFrame, batch: int) -> None:
        if name not in targets:
            return
        if execute:
            jdbc_upsert(df, dict(targets[name]), keys[name], execute)
        elif name == "sessions":
            jdbc_write(df.withColumn("batch", F.lit(batch)), dict(targets[name]), "append")
        else:
            jdbc_write(df, dict(targets[name]), "overwrite")

    return write
