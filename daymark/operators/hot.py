"""Ordered per-key work that stays spread out when one key holds much of the table.

A plain window sorts all rows of a key in one task. The functions here first find the
keys with more than ``max_rows`` rows (one aggregation with map-side combine), and cut
only those keys into *cells*: consecutive slices of the range of the order columns. Cells
of a key follow one another in order, so a window runs per (key, cell), and what a cell
needs from the cells before it comes from a small summary.

The tables of hot keys and cells have about one row per 0.8 million rows with the defaults. They
are joined without a hint, so Spark broadcasts them as long as their bytes allow it. Without hot
keys they are empty and adaptive execution drops their branches. A key whose order begins with a
text column has no range to cut and stays in one cell.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..session import materialize
from .scan import range_cells

MAX_ROWS = 10_000_000
SLICES = 4
LEVELS = 3

# Cells are numbered level by level; three levels of two million slices fill a bigint.
CELL_BASE = 1 << 21

# Types whose sums can be taken apart again without rounding.
_EXACT = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType)


def ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


def descending(order: Sequence[str]) -> list[Column]:
    """Exact reverse of :func:`ascending`."""
    return [F.col(c).desc_nulls_first() for c in order]


def _same_keys(keys: Sequence[str]) -> Column:
    """Join condition of keys with their ``_on_`` copies, under which NULL keys match."""
    return reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in keys]
    )


def _on(keys: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"_on_{c}") for c in keys]


def _number(df: DataFrame, column: str) -> Column | None:
    """The column as a number that keeps its order and equality; None for other types."""
    kind, value = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        clock = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        return (F.unix_date(value.cast("date")) * F.lit(86400.0)) + clock
    return value.cast("double") if isinstance(kind, T.NumericType) else None


def _axes(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """The leading order columns that are numbers, dates or timestamps, as numbers."""
    axes = []
    for column in order:
        number = _number(df, column)
        if number is None:
            break
        axes.append(number)
    return axes


def _slices(
    df: DataFrame,
    groups: Sequence[str],
    axes: Sequence[Column],
    max_rows: int,
    totals: Mapping[str, Column],
) -> DataFrame:
    """Groups above ``max_rows`` rows: the first order column that tells their rows apart,
    its range, and the number of slices to cut it into."""
    stats = (
        df.groupBy(*groups)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.min(a).alias(f"_low{i}") for i, a in enumerate(axes)],
            *[F.max(a).alias(f"_high{i}") for i, a in enumerate(axes)],
            *[F.count(a).alias(f"_known{i}") for i, a in enumerate(axes)],
            *[total.alias(name) for name, total in totals.items()],
        )
        .where(F.col("_rows") > max_rows)
    )
    axis, low, span = F.lit(None).cast("int"), F.lit(None), F.lit(None)
    for i in reversed(range(len(axes))):
        known = F.col(f"_known{i}")
        varies = (F.col(f"_high{i}") > F.col(f"_low{i}")) | (
            (known > 0) & (known < F.col("_rows"))
        )
        axis = F.when(varies, F.lit(i)).otherwise(axis)
        low = F.when(varies, F.col(f"_low{i}")).otherwise(low)
        span = F.when(varies, F.col(f"_high{i}") - F.col(f"_low{i}")).otherwise(span)
    return stats.select(
        *_on(groups),
        axis.alias("_axis"),
        low.cast("double").alias("_low"),
        span.cast("double").alias("_span"),
        F.ceil(F.col("_rows") * F.lit(SLICES) / F.lit(max_rows)).alias("_slices"),
        *totals,
    )


def _slice_number(axes: Sequence[Column]) -> Column:
    """Slice of a row in its group: 0 in ordinary groups, NULLs after all slices."""
    value = F.lit(None).cast("double")
    for i, axis in enumerate(axes):
        value = F.when(F.col("_axis") == i, axis).otherwise(value)
    share = F.coalesce(F.try_divide(value - F.col("_low"), F.col("_span")), F.lit(0.0))
    number = F.least(F.floor(share * F.col("_slices")), F.col("_slices") - 1)
    whole = F.col("_axis").isNull()
    return (
        F.when(whole, F.lit(0)).when(value.isNull(), F.col("_slices")).otherwise(number)
    ).cast("bigint")


def split_hot(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int = MAX_ROWS,
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``_cell`` (0 for ordinary keys) and ``_hot`` to every row.

    Hot keys are sliced, and slices that still hold more than ``max_rows`` rows are sliced
    again within their own range, ``LEVELS`` times in all: outliers, crowded times and a
    single date with very many rows (told apart by the next order column) are spread as
    well. ``totals`` are aggregates over a whole key, added to the rows of hot keys only.
    """
    totals = totals or {}
    axes = _axes(df, order)
    if len(axes) < len(order):
        return split_by_ranges(df, keys, order, max_rows, totals)
    hot = _slices(df, keys, axes, max_rows, totals)
    cut = df.join(hot, _same_keys(keys), "left").select(
        *df.columns,
        *totals,
        F.col("_slices").isNotNull().alias("_hot"),
        _slice_number(axes).alias("_cell"),
    )
    columns = [c for c in cut.columns if c != "_cell"]
    for _ in range(LEVELS - 1):
        groups = [*keys, "_cell"]
        crowded = _slices(cut.where("_hot"), groups, axes, max_rows, {})
        finer = F.col("_cell") * F.lit(CELL_BASE) + _slice_number(axes)
        cut = cut.join(crowded, _same_keys(groups), "left").select(
            *columns, finer.alias("_cell")
        )
    return cut


def split_by_ranges(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int = MAX_ROWS,
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """:func:`split_hot` for orders of any types: cells are slices of ranges of (keys, order).

    Only rows of hot keys are dealt out, and each cell holds at most a quarter of ``max_rows``. A
    cell may hold the end of one key and the beginning of the next: cells of a key are numbered
    in order, with gaps. Without hot keys nothing is dealt out.
    """
    totals = totals or {}
    counted = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[total.alias(name) for name, total in totals.items()]
    )
    hot = materialize(counted.where(F.col("_rows") > max_rows).select(*_on(keys), "_rows", *totals))
    rows = hot.agg(F.sum("_rows")).first()[0]
    if rows is None:
        nothing = [F.lit(None).cast(hot.schema[name].dataType).alias(name) for name in totals]
        return df.select(*df.columns, *nothing, F.lit(False).alias("_hot"), F.lit(0).cast("bigint").alias("_cell"))
    marked = df.join(hot, _same_keys(keys), "left").select(
        *df.columns, *totals, F.col("_rows").isNotNull().alias("_hot")
    )
    places = [F.col(c).asc_nulls_first() for c in keys] + ascending(order)
    dealt = range_cells(marked.where("_hot"), places, rows, max(1, max_rows // SLICES))
    return dealt.unionByName(marked.where(~F.col("_hot")).withColumn("_cell", F.lit(0).cast("bigint")))


def _sum_type(kind: T.DataType) -> T.DataType:
    """The type that Spark gives the sum of a bigint or decimal column."""
    if isinstance(kind, T.DecimalType):
        return T.DecimalType(min(38, kind.precision + 10), kind.scale)
    return T.LongType()


def _cell_window(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("_cell")


def _borrowed_rows(
    hot: DataFrame, keys: Sequence[str], order: Sequence[str], count: int
) -> DataFrame:
    """For every cell, copies of the ``count`` rows of its key that come just before it.

    Only the last ``count`` rows of a cell can be wanted (a row-number filter, limited
    before the shuffle). Cell sizes give their exact positions, and each is copied to those
    of the next cells that start close enough; usually that is one.
    """
    by_cell = _cell_window(keys)
    end = F.sum("_rows").over(by_cell.rowsBetween(Window.unboundedPreceding, 0))
    cell = F.struct(F.col("_cell").alias("cell"), (F.col("_end") - F.col("_rows")).alias("start"))
    following = F.collect_list(cell).over(by_cell.rowsBetween(1, count))
    cells = (
        hot.groupBy(*keys, "_cell")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_end", end)
        .select(
            *_on([*keys, "_cell"]),
            "_end",
            following.alias("_next"),
        )
        .withColumn("_next", F.filter("_next", lambda c: c["start"] < F.col("_end") + F.lit(count)))
    )
    back = Window.partitionBy(*keys, "_cell").orderBy(*descending(order))
    tails = hot.withColumn("_back", F.row_number().over(back)).where(F.col("_back") <= count)
    limit = F.col("_end") - F.col("_back") + F.lit(count)
    following = F.filter("_next", lambda c: c["start"] <= limit)
    return tails.join(cells, _same_keys([*keys, "_cell"])).select(
        *[c for c in hot.columns if c != "_cell"],
        F.explode(F.transform(following, lambda c: c["cell"])).alias("_cell"),
    )


def rolling_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    rows: int,
    out: str,
    min_rows: int = 1,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the current row and the ``rows - 1`` before it, per key.

    ``order`` must be a total order within a key. Early windows with fewer than ``rows``
    rows count as they are; with ``min_rows`` shorter ones give NULL.
    """
    split = split_hot(df, keys, order, max_rows)
    cut = split.withColumn("_own", F.lit(True))
    if rows > 1:
        borrowed = _borrowed_rows(split.where("_hot"), keys, order, rows - 1)
        cut = cut.unionByName(borrowed.withColumn("_own", F.lit(False)))
    by_order = Window.partitionBy(*keys, "_cell").orderBy(*ascending(order))
    kind = df.schema[value].dataType
    if isinstance(kind, _EXACT):
        # Running totals minus the totals ``rows`` rows earlier: one pass, where a sliding
        # frame would add up all its rows again for every row. The totals run over the whole
        # cell, so they get more digits than the sums that are asked for.
        added = F.col(value)
        if isinstance(kind, T.LongType):
            added = added.cast("decimal(38,0)")
        elif isinstance(kind, T.DecimalType):
            added = added.cast(T.DecimalType(38, kind.scale))
        so_far = by_order.rowsBetween(Window.unboundedPreceding, 0)
        cut = cut.withColumns(
            {"_sum": F.sum(added).over(so_far), "_count": F.count(value).over(so_far)}
        )
        earlier = {c: F.lag(c, rows).over(by_order) for c in ("_sum", "_count")}
        gained = {c: F.col(c) - F.coalesce(e, F.lit(0)) for c, e in earlier.items()}
        total = F.when(gained["_count"] > 0, gained["_sum"])
        if isinstance(kind, (T.LongType, T.DecimalType)):
            total = total.cast(_sum_type(kind))
    else:
        total = F.sum(value).over(by_order.rowsBetween(1 - rows, 0))
    if min_rows > 1:
        total = F.when(F.lag(F.lit(1), min_rows - 1).over(by_order) == 1, total)
    kept = [c for c in df.columns if c != out]
    return cut.select(*kept, total.alias(out), "_own").where("_own").drop("_own")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Sum of ``value`` up to and including the current row, per key (a ROWS frame)."""
    cut = split_hot(df, keys, order, max_rows)
    earlier = F.sum("_sum").over(_cell_window(keys).rowsBetween(Window.unboundedPreceding, -1))
    before = (
        cut.where("_hot")
        .groupBy(*keys, "_cell")
        .agg(F.sum(value).alias("_sum"))
        .select(*_on([*keys, "_cell"]), earlier.alias("_before"))
    )
    frame = (
        Window.partitionBy(*keys, "_cell")
        .orderBy(*ascending(order))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = cut.withColumn("_local", F.sum(value).over(frame))
    total = F.when(F.col("_before").isNull(), F.col("_local")).otherwise(
        F.col("_before") + F.coalesce(F.col("_local"), F.lit(0))
    )
    kept = [c for c in df.columns if c != out]
    return local.join(before, _same_keys([*keys, "_cell"]), "left").select(
        *kept, total.alias(out)
    )


def next_time(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    wanted: str,
    out: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Time of the first row at or after this one, in the same key, where ``wanted`` holds.

    Takes one pass over ordered rows instead of joining every row with all later ones. Both
    windows run backwards in time, because Spark recomputes a frame that ends at the last
    row for every row.
    """
    cut = split_hot(df, keys, [ts], max_rows)
    from_last = Window.partitionBy(*keys).orderBy(F.desc("_cell"))
    hit = F.when(F.col(wanted), F.col(ts))
    following = F.min("_first").over(from_last.rowsBetween(Window.unboundedPreceding, -1))
    later = (
        cut.where("_hot")
        .groupBy(*keys, "_cell")
        .agg(F.min(hit).alias("_first"))
        .select(*_on([*keys, "_cell"]), following.alias("_later"))
    )
    frame = (
        Window.partitionBy(*keys, "_cell")
        .orderBy(F.col(ts).desc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = cut.withColumn("_local", F.min(hit).over(frame))
    kept = [c for c in df.columns if c != out]
    return found.join(later, _same_keys([*keys, "_cell"]), "left").select(
        *kept, F.coalesce("_local", "_later").alias(out)
    )


def chained_times(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    steps: Sequence[str],
    limits: Sequence[dt.timedelta],
    out: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Times at which each row's key goes through ``steps`` from that row on, one after another.

    ``out`` is an array with a time per step: that of the first row at or after the step
    before where the step's column holds, if it lies within the step's limit, else NULL, as all
    times after it. Steps are worked out from the last to the first. A row where a step holds
    carries the times of the steps after it, so one search backwards in time per step, over rows
    that are cut and ordered once, gives whole chains, and no pairs of rows arise.
    """
    cut = split_hot(df, keys, [ts], max_rows)
    frame = (
        Window.partitionBy(*keys, "_cell")
        .orderBy(F.col(ts).desc_nulls_first())
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    from_last = Window.partitionBy(*keys).orderBy(F.desc("_cell"))
    following = F.min("_first").over(from_last.rowsBetween(Window.unboundedPreceding, -1))
    times = T.ArrayType(df.schema[ts].dataType)
    found = cut.withColumn("_rest", F.array().cast(times))
    for left, (wanted, limit) in enumerate(reversed(list(zip(steps, limits, strict=True))), 1):
        hit = F.when(F.col(wanted), F.struct(F.col(ts).alias("at"), F.col("_rest").alias("rest")))
        later = (
            found.where("_hot")
            .groupBy(*keys, "_cell")
            .agg(F.min(hit).alias("_first"))
            .select(*_on([*keys, "_cell"]), following.alias("_later"))
        )
        local = found.withColumn("_local", F.min(hit).over(frame))
        reached = F.coalesce("_local", "_later")
        in_time = reached["at"] <= F.col(ts) + F.lit(limit)
        chain = F.concat(F.array(reached["at"]), reached["rest"])
        never = F.array_repeat(F.lit(None).cast(times.elementType), left)
        found = local.join(later, _same_keys([*keys, "_cell"]), "left").select(
            *cut.columns, F.when(in_time, chain).otherwise(never).alias("_rest")
        )
    return found.select(*[c for c in df.columns if c != out], F.col("_rest").alias(out))


def longest_run(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    holds: str,
    out: str,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Length of the longest unbroken run of rows where ``holds`` is true, per key.

    A NULL breaks a run. A key without a run gives NULL. The rows are shuffled once; each
    cell is then summed up in its head run, tail run and best run, and runs that cross
    cells are put together from these.
    """
    cut = split_hot(df, keys, order, max_rows)
    cell_keys = [*keys, "_cell"]
    frame = (
        Window.partitionBy(*cell_keys)
        .orderBy(*ascending(order))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    breaks = F.sum(F.when(F.col(holds), 0).otherwise(1)).over(frame)
    cells = (
        cut.withColumn("_run", breaks)
        .groupBy(*cell_keys, "_run")
        .agg(F.count(F.when(F.col(holds), 1)).alias("_length"))
        .groupBy(*cell_keys)
        .agg(
            F.max(F.when(F.col("_run") == 0, F.col("_length")).otherwise(0)).alias("_head"),
            F.max_by("_length", "_run").alias("_tail"),
            F.max("_length").alias("_best"),
            (F.max("_run") > 0).alias("_broken"),
        )
    )
    chain = F.coalesce(
        F.sum(F.col("_broken").cast("int")).over(
            _cell_window(keys).rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    head = F.struct(F.col("_chain").alias("chain"), F.col("_head").alias("length"))
    tail = F.struct((F.col("_chain") + 1).alias("chain"), F.col("_tail").alias("length"))
    ends = F.when(F.col("_broken"), F.array(head, tail)).otherwise(F.array(head))
    return (
        cells.withColumn("_chain", chain)
        .select(*keys, "_best", F.inline(ends))
        .groupBy(*keys, "chain")
        .agg(F.sum("length").alias("length"), F.max("_best").alias("_best"))
        .groupBy(*keys)
        .agg(F.nullif(F.greatest(F.max("length"), F.max("_best")), F.lit(0)).alias(out))
    )
