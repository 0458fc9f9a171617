"""Files and bytes of stored tables, and comparison of sort layouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_path, shared
from .writers import sorted_write


def file_report(df: DataFrame, layout: str) -> DataFrame:
    """Files, bytes and rows behind a stored table, from the file metadata columns."""
    per_file = df.groupBy(
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    return per_file.agg(
        F.count("_path").alias("num_files"),
        F.sum("_size").alias("size_bytes"),
        F.sum("_rows").alias("num_rows"),
    ).select(F.lit(layout).alias("layout"), "num_files", "size_bytes", "num_rows")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def compare_layouts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """One report line per stored layout."""
    return union_all([file_report(spark.read.parquet(p), name) for name, p in paths.items()])


def layout_report(df: DataFrame, sort_columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Write ``df`` once per sort column and compare files and bytes.

    Even partitions sorted inside by a column with long runs compress better; the report
    shows by how much. The copies go to the shared folder.
    """
    paths = {f"sorted_by_{c}": new_path(df.sparkSession, f"sorted_by_{c}") for c in sort_columns}
    with shared(df) as rows:
        for path, column in zip(paths.values(), sort_columns):
            sorted_write(rows, path, column, partitions)
    return compare_layouts(df.sparkSession, paths)
