"""Table writers: overwrite, snapshot, upsert, bucketed, sorted and JDBC."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import materialize


def overwrite_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a managed table, or one kept at ``path``."""
    writer = df.write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_snapshot(df: DataFrame, path: str, partition: str | Sequence[str]) -> None:
    """Replace only the partitions present in ``df``; a second run gives the same table.

    Rows are brought together by partition value first, in as many tasks as the shuffle
    has and adaptive execution finds needed, so a snapshot is not written as one small
    file per task and partition.
    """
    columns = [partition] if isinstance(partition, str) else list(partition)
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def upsert(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], partition: str
) -> None:
    """Insert ``rows``, replacing stored rows with the same keys.

    Only partitions that ``rows`` touches are read and rewritten. They are read and written
    at the same place, so the merged rows are checkpointed in the shared folder before the
    write begins. A path without a table takes the rows as its first load. ``partition`` must
    be one of ``keys``, or a row that moves to another partition would be stored twice. NULL
    keys are equal to each other.
    """
    if partition not in keys:
        raise ValueError(f"{partition!r} must be among the keys")
    rows = materialize(rows)
    if not table_exists(spark, path):
        write_snapshot(rows, path, partition)
        return
    stored = spark.read.parquet(path).join(
        rows.select(F.col(partition).alias("_touched")).distinct(),
        F.col(partition).eqNullSafe(F.col("_touched")),
        "left_semi",
    )
    kept = _without(stored, rows, keys)
    write_snapshot(materialize(kept.unionByName(rows)), path, partition)


def delete_rows(df: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are not among ``doomed``; write the result over the table.

    NULL keys are equal to each other.
    """
    return _without(df, doomed, keys)


def _without(df: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    gone = others.select(*[F.col(c).alias(f"_gone_{c}") for c in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_gone_{c}")) for c in keys])
    return df.join(gone, same, "left_anti")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table can be read at ``path``."""
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def bucket_write(
    df: DataFrame,
    name: str,
    keys: Sequence[str],
    buckets: int = 16,
    path: str | None = None,
) -> None:
    """Write a table bucketed and sorted by ``keys``.

    Two tables written with the same keys and bucket count join without a shuffle. Spread
    the rows by the keys first, over a multiple of the bucket count: a task then writes to one
    bucket only, and a bucket is written by as many tasks as the session's shuffles have per
    bucket. A key with more rows than one bucket should hold is
    given a salt beforehand (operators.matches.salt_hot_keys).
    """
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    writer = (
        df.repartition(buckets * max(1, -(-shuffle // buckets)), *keys)
        .write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


# Rows that one task of a sorted write sorts, about; bytes that it packs at once.
RANGE_ROWS = 100_000
PACK_BYTES = 64 << 20


def sorted_write(df: DataFrame, path: str, sort_by: str, partitions: int | None = None) -> None:
    """Write evenly sized files sorted inside by one column.

    The number of files is that of the session's shuffles unless ``partitions`` is given. A file
    is written by one task, so rows are sorted before, in ranges of the column whose number
    follows the rows, which are counted first. A range is dealt out to all files; a file gets
    from each a few rows that hold many, packed and compressed by Arrow, and puts these in order.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, -(-df.count() // RANGE_ROWS))
    # Frequent values are cut by the other columns; maps and variants have no hash.
    hashed = [F.col(c) for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    rows = df.withColumn("_tie", F.xxhash64(*hashed)).repartitionByRange(ranges, sort_by, "_tie")
    rows = rows.sortWithinPartitions(sort_by, "_tie").drop("_tie")
    packed = rows.mapInArrow(_packed(partitions, PACK_BYTES), "file int, rows binary")
    # The number of a packed row rises with its range and its place in it.
    dealt = packed.withColumn("at", F.monotonically_increasing_id())
    dealt = dealt.repartitionById(partitions, F.col("file")).sortWithinPartitions("at")
    dealt.select("rows").mapInArrow(_unpacked(), df.schema).write.mode("overwrite").parquet(path)


def _packed(files: int, most: int):
    """Deals the rows of a task to files in turn: one packed row for a file and ``most`` bytes."""

    def packed(batches):
        import pyarrow as pa

        def dealt(held):
            table = pa.Table.from_batches(held).combine_chunks()
            for file in range(min(files, table.num_rows)):
                sink = pa.BufferOutputStream()
                options = pa.ipc.IpcWriteOptions(compression="zstd")
                with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
                    writer.write_table(table.take(pa.array(range(file, table.num_rows, files))))
                rows = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), rows], ["file", "rows"])

        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= most:
                yield from dealt(held)
                held, size = [], 0
        if held:
            yield from dealt(held)

    return packed


def _unpacked():
    def unpacked(batches):
        import pyarrow as pa

        for batch in batches:
            for rows in batch.column(0):
                with pa.ipc.open_stream(rows.as_buffer()) as reader:
                    yield from reader

    return unpacked


# Rows per JDBC statement batch.
JDBC_BATCH_ROWS = 500


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    batch_rows: int = JDBC_BATCH_ROWS,
) -> dict[str, str]:
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_rows),
    }


def jdbc_write(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    """Write over JDBC; failed tasks are tried again as often as ``spark.task.maxFailures``.

    An overwrite empties the table and keeps its definition.
    """
    writer = df.write.format("jdbc").options(**options).mode(mode)
    if mode == "overwrite":
        writer = writer.option("truncate", "true")
    writer.save()


def upsert_statement(table: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    """One statement that puts the rows of ``staging`` into ``table``, by its unique ``keys``.

    Rows that are in the staging table twice, as after a repeated task, count once.
    """
    missing = [k for k in keys if k not in columns]
    if not keys or missing:
        raise ValueError(f"keys must be among the columns: {missing or keys}")

    def listed(names: Sequence[str]) -> str:
        return ", ".join(_quoted(n) for n in names)

    changes = ", ".join(f"{_quoted(c)} = EXCLUDED.{_quoted(c)}" for c in columns if c not in keys)
    action = f"DO UPDATE SET {changes}" if changes else "DO NOTHING"
    return (
        f"INSERT INTO {table} ({listed(columns)}) SELECT DISTINCT {listed(columns)} FROM {staging} "
        f"WHERE TRUE ON CONFLICT ({listed(keys)}) {action}"
    )


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def jdbc_upsert(
    df: DataFrame, options: dict[str, str], keys: Sequence[str], execute: Callable[[str], object]
) -> None:
    """Insert or replace rows over JDBC, so that a write that runs again changes nothing.

    All tasks fill a staging table beside ``options["dbtable"]``; then ``execute``, for instance
    the ``execute`` of a connection that commits by itself, runs one statement, and readers see
    all rows of the write or none. The target needs a unique constraint on ``keys``. Two
    writes to one target must not run at the same time.
    """
    table = options["dbtable"]
    staging = f"{table}_staging"
    statement = upsert_statement(table, staging, df.columns, keys)
    jdbc_write(df, {**options, "dbtable": staging}, "overwrite")
    execute(statement)
