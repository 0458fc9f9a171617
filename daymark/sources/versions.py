"""Tables in versions: new files are staged and checked, and readers follow a list of files.

``path/data/run=<id>`` holds the files of a run and ``path/versions/n=<number>`` one small file
that lists the data files of a version. It appears in one step when its write is committed, so
readers see the old version or the new one whole, and a run that fails, or whose rows fail their
checks, changes nothing for them. Deletes and upserts write anew only the files that hold rows
they touch and list all others again. One writer works at a time: a second one that
commits the same version number gets an error. Files of old versions are left to the owner.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.quality import key_violations
from ..session import materialize
from .writers import table_exists

FILE, RUN, NUMBER = "_file", "run", "n"


@dataclass(frozen=True)
class Published:
    """What came of a run: its version (None if its checks failed) and its numbers of rows."""

    run: str
    version: int | None
    accepted: int
    rejected: int


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"file string, {NUMBER} long").parquet(f"{path}/versions")


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The number of the version that readers see; None before the first one."""
    if not table_exists(spark, f"{path}/versions"):
        return None
    return _versions(spark, path).agg(F.max(NUMBER)).first()[0]


def version_files(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """The files of a version, the latest one by default. Spark's own index of a table's files
    has the same size."""
    version = latest_version(spark, path) if version is None else version
    listed = _versions(spark, path).where(F.col(NUMBER) == version).select("file")
    return [r["file"] for r in listed.toLocalIterator() if r["file"] is not None]


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the latest one by default."""
    files = version_files(spark, path, version)
    if not files:
        raise FileNotFoundError(f"{path} has no version with rows")
    return _read(spark, files).drop("_rules")


def _read(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """The rows of some files; those of checked runs have the (empty) list of broken rules."""
    return spark.read.option("mergeSchema", True).parquet(*[unquote(f) for f in files])


def _commit(spark: SparkSession, path: str, files: Sequence[str]) -> int:
    """List ``files`` as the next version; an empty version has one line without a file."""
    number = (latest_version(spark, path) or 0) + 1
    lines = spark.createDataFrame([(f,) for f in files] or [(None,)], "file string")
    lines.coalesce(1).write.mode("errorifexists").parquet(f"{path}/versions/{NUMBER}={number}")
    return number


def _written(df: DataFrame, path: str) -> list[str]:
    """Write the rows of a run and return its files."""
    target = f"{path}/data/{RUN}={uuid.uuid4().hex}"
    df.write.parquet(target)
    return sorted(df.sparkSession.read.schema(df.schema).parquet(target).inputFiles())


def _same(keys: Sequence[str]) -> Column:
    pairs = [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def _on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_on_{k}") for k in keys]).distinct()


def broken_rules(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``_rules``, the names of the rules that a row breaks.

    A rule is a condition that must be true; NULL breaks it. With ``keys``, every row of a key
    that is NULL or stands there twice breaks the rule ``key``. Keys are counted before they
    meet the rows.
    """
    broken = [F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    if keys:
        bad = _on(key_violations(df, keys), keys).withColumn("_bad", F.lit(True))
        df = df.join(bad, _same(keys), "left").drop(*[f"_on_{k}" for k in keys])
        broken.append(F.when(F.col("_bad"), F.lit("key")))
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn("_rules", names).drop("_bad")


def publish(
    df: DataFrame,
    path: str,
    rules: Mapping[str, Column],
    keys: Sequence[str] = (),
    max_rejected: float = 0.0,
    append: bool = False,
) -> Published:
    """Write, check, and only then show ``df`` to readers, in place of the last version or
    (``append``) beside it.

    Rows that break no rule are accepted. If the share of the others is above ``max_rejected``,
    the version stays as it is. Rejected rows and their rules go to the rejects of the run
    either way (:func:`read_rejects`). All rows are written once, both kinds in folders of
    their own; the check reads what was written.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    staged = f"{path}/staged/{RUN}={run}"
    marked = broken_rules(df, rules, keys).withColumn("_ok", F.size("_rules") == 0)
    marked.write.partitionBy("_ok").parquet(staged)
    schema = df.withColumn("_rules", F.array().cast("array<string>")).withColumn("_ok", F.lit(True)).schema
    written = spark.read.schema(schema).parquet(staged)
    counts = written.agg(F.count_if("_ok").alias("good"), F.count_if(~F.col("_ok")).alias("bad")).first()
    good, bad = counts["good"], counts["bad"]
    if bad > max_rejected * (good + bad):
        return Published(run, None, 0, bad)
    new = sorted(written.where("_ok").drop("_rules", "_ok").inputFiles()) if good else []
    before = version_files(spark, path) if append and latest_version(spark, path) else []
    return Published(run, _commit(spark, path, before + [f for f in new if "/_ok=true/" in f]), good, bad)


def read_rejects(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The rows that a run rejected, with ``rules``, the rules that they broke."""
    staged = spark.read.parquet(f"{path}/staged/{RUN}={run}")
    return staged.where(~F.col("_ok")).drop("_ok").withColumnRenamed("_rules", "rules")


def _located(spark: SparkSession, files: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """The keys of some files' rows with a hash of their file's name: 8 bytes to sort, not hundreds."""
    return _read(spark, files).select(*keys, F.xxhash64(F.input_file_name()).alias(FILE))


def _touched(spark: SparkSession, path: str, keys_of: DataFrame, keys: Sequence[str]) -> tuple[list[str], list[str]]:
    """All files of the latest version, and those of them that hold rows with the given keys.

    Two files of one hash would both count as touched, and be written anew with all other rows.
    """
    files = version_files(spark, path)
    if not files:
        return [], []
    named = spark.createDataFrame([(f,) for f in files], "name string").select("name", F.xxhash64("name").alias(FILE))
    names = {r["name"]: r[FILE] for r in named.toLocalIterator()}
    rows = _located(spark, files, keys)
    touched = rows.join(_on(keys_of, keys), _same(keys), "left_semi").select(FILE).distinct()
    hit = {r[FILE] for r in touched.toLocalIterator()}
    if not hit <= set(names.values()):
        raise ValueError(f"{path}: rows lie in files that the version does not list by their names")
    return files, [f for f in files if names[f] in hit]


def delete_from(spark: SparkSession, path: str, doomed: DataFrame, keys: Sequence[str]) -> list[str]:
    """Delete the rows whose keys are among ``doomed``; returns the files that were replaced.

    Only these are read in full and written anew, without the rows. NULL keys are equal to each
    other. If no row goes, there is no new version.
    """
    gone = materialize(doomed.select(*keys).distinct())
    files, hit = _touched(spark, path, gone, keys)
    if hit:
        kept = _read(spark, hit).join(_on(gone, keys), _same(keys), "left_anti")
        new = _written(kept.drop("_rules"), path)
        _commit(spark, path, [f for f in files if f not in set(hit)] + new)
    return hit


def upsert_into(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str]) -> list[str]:
    """Insert ``rows``, replacing rows with the same keys; returns the files that were replaced.

    The rest of the files that hold replaced rows is written anew together with ``rows``; all
    others stay. NULL keys are equal to each other. A path without a version gets its first one.
    """
    rows = materialize(rows)
    if latest_version(spark, path) is None:
        _commit(spark, path, _written(rows, path))
        return []
    files, hit = _touched(spark, path, rows, keys)
    if hit:
        kept = _read(spark, hit).drop("_rules").join(_on(rows, keys), _same(keys), "left_anti")
        rows = kept.unionByName(rows)
    _commit(spark, path, [f for f in files if f not in set(hit)] + _written(rows, path))
    return hit
