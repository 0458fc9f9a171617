"""Work in one order over whole tables, spread over range partitions.

Rows are dealt to consecutive ranges of the order, each about as large as the others whatever
keys or values are frequent, because the ranges are cut by a sample of the rows and not by
key. What a range needs from those before it is one small row for each of them.

Ranges are cut anew each time that a plan runs, so what was dealt out is checkpointed before
anything is computed from it.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize

#: monotonically_increasing_id has the partition above these bits and the row below.
ROW_BITS = 33

#: Rows of a range, where the session's shuffles have too few partitions for that.
RANGE_ROWS = 250_000


def tie_break(df: DataFrame) -> Column:
    """Tells rows apart that agree in the columns of an order but not in all columns."""
    return F.xxhash64(*df.columns)


def range_cells(df: DataFrame, order: Sequence[Column], rows: int, cell_rows: int) -> DataFrame:
    """``df``, which has ``rows`` rows, with ``_cell``: consecutive slices of ``order`` of at most
    ``cell_rows`` rows, numbered in order with gaps.

    Cells are cut from sorted ranges, so the number of tasks, files and samples follows the rows
    and not the cells. Rows that agree in ``order`` are told apart by a hash of all columns and
    may lie in several cells.
    """
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = min(-(-rows // cell_rows), max(shuffle, -(-rows // RANGE_ROWS)))
    keys = [*order, F.col("_tie")]
    dealt = df.withColumn("_tie", tie_break(df)).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    dealt = dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    cell = F.col("_at") - row + F.floor(row / F.lit(cell_rows)).cast("bigint")
    return materialize(dealt.select(*df.columns, cell.alias("_cell")))


def numbered(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """``df`` with ``out``, the place of a row in ``order`` over the whole table, from 1.

    Rows that agree in ``order`` follow one another by a hash of all columns. Each range
    counts its rows; the counts, one pair of numbers per range, come to the driver and go back as
    offsets, whose size Spark then knows.
    """
    keys = [*order, F.col("_tie")]
    dealt = df.withColumn("_tie", tie_break(df)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = materialize(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", ROW_BITS)
    counts = dealt.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.sort_array(F.collect_list(F.struct("part", "n")))).first()[0]
    before = list(accumulate((n for _, n in sizes), initial=0))[:-1]
    starts = [(p, b) for (p, _), b in zip(sizes, before, strict=True)]
    offsets = df.sparkSession.createDataFrame(starts, "_part long, _before long")
    row = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    joined = dealt.join(offsets, part == F.col("_part"))
    return joined.select(*[c for c in df.columns if c != out], (F.col("_before") + row + 1).alias(out))
