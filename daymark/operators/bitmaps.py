"""Exact distinct counts from bitmaps that can be stored, merged and counted again.

An id sets one bit: its bucket says which bitmap, its place which of the 32,768 bits in it.
Bitmaps of the same bucket are merged with OR, so days add up to weeks, months or any other
stretch, and keys to totals, without the events. Any bigint is an id, negative ones included.

Ids given out in a row fill such bitmaps best, while ids all over the range would cost 4 KB each,
and those are sorted to be merged. For these ``spread=True`` makes bitmaps of 64 ids that are one
bigint each. They are merged in hash maps without a sort, and all functions here take either kind.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.dates import day_literal, day_of

BUCKET, BITS = "bucket", "bitmap"

#: A bitmap of spread ids is a bigint of 2^6 bits.
WORD_BITS = 6


def daily_bitmaps(
    events: DataFrame,
    visitor: str,
    ts: str,
    keys: Sequence[str] = (),
    out: str = "day",
    spread: bool = False,
) -> DataFrame:
    """One bitmap per day, key and bucket of visitors; a NULL visitor or time sets no bit.

    Bits are set before the shuffle, which carries one bitmap per task and group. ``spread``
    makes buckets of 64 ids, for ids that lie far apart.
    """
    known = events.where(F.col(visitor).isNotNull() & F.col(ts).isNotNull())
    number = F.col(visitor).cast("bigint")
    if spread:
        place = number.bitwiseAND(F.lit((1 << WORD_BITS) - 1)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        bucket, bits = F.shiftright(number, WORD_BITS), F.bit_or(bit)
    else:
        bucket = F.bitmap_bucket_number(number)
        bits = F.bitmap_construct_agg(F.bitmap_bit_position(number))
    return known.groupBy(*keys, day_of(ts).alias(out), bucket.alias(BUCKET)).agg(bits.alias(BITS))


def _kind(bitmaps: DataFrame) -> tuple[str, Callable[..., Column], Callable[..., Column]]:
    """Type of the bitmaps, how they are merged and how their bits are counted."""
    if isinstance(bitmaps.schema[BITS].dataType, T.LongType):
        return "bigint", F.bit_or, lambda c: F.bit_count(c).cast("bigint")
    return "binary", F.bitmap_or_agg, F.bitmap_count


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[Column | str] = ()) -> DataFrame:
    """One bitmap per group and bucket."""
    _, merge, _ = _kind(bitmaps)
    return bitmaps.groupBy(*by, BUCKET).agg(merge(BITS).alias(BITS))


def count_distinct(
    bitmaps: DataFrame, by: Sequence[Column | str] = (), out: str = "visitors"
) -> DataFrame:
    """Distinct visitors per group."""
    merged = merge_bitmaps(bitmaps, by)
    groups = [c for c in merged.columns if c not in (BUCKET, BITS)]
    total = F.coalesce(F.sum(_kind(bitmaps)[2](BITS)), F.lit(0).cast("bigint"))
    return merged.groupBy(*groups).agg(total.alias(out))


def rolling_distinct(
    bitmaps: DataFrame,
    windows: Mapping[str, int],
    first: dt.date | str,
    last: dt.date | str,
    keys: Sequence[str] = (),
    day: str = "day",
) -> DataFrame:
    """Distinct visitors of the last so many days, for every day of a range and every window.

    ``windows`` maps a column to its number of days. A bucket holds one row per day, however
    many events there were, and its bitmaps are merged along the days, so nothing is multiplied
    by the length of a window. Days without visitors count the days before them; a key without
    any visitor has no rows.
    """
    start, end = day_literal(first), day_literal(last)
    kind, merge, count = _kind(bitmaps)
    stored = bitmaps.select(*keys, BUCKET, day, BITS, F.lit(False).alias("_asked"))
    asked = (
        bitmaps.select(*keys, BUCKET)
        .distinct()
        .select(
            *keys,
            BUCKET,
            F.explode(F.sequence(start, end)).alias(day),
            F.lit(None).cast(kind).alias(BITS),
            F.lit(True).alias("_asked"),
        )
    )
    in_bucket = Window.partitionBy(*keys, BUCKET).orderBy(F.unix_date(day))
    # A frame without bitmaps holds no visitors: bit_or gives NULL there, bitmap_or_agg no bits.
    counts = {
        name: F.coalesce(count(merge(BITS).over(in_bucket.rangeBetween(1 - days, 0))), F.lit(0))
        for name, days in windows.items()
    }
    rows = stored.unionByName(asked).withColumns(counts).where("_asked")
    return rows.groupBy(*keys, day).agg(*[F.sum(name).alias(name) for name in windows])


def period_changes(
    bitmaps: DataFrame,
    period: Column,
    next_period: Column,
    keys: Sequence[str] = (),
    out: str = "period",
) -> DataFrame:
    """Active, retained, arrived and lost visitors per period, against the period before.

    ``next_period`` is the period after ``period`` as an expression over the column named
    ``out``. Every period's bitmaps also stand for the one after it; those active in both are
    the two counts less that of the union. The period after the last one shows whom it lost.
    """
    kind, merge, count = _kind(bitmaps)
    by_period = merge_bitmaps(bitmaps, [*keys, period.alias(out)])
    sides = F.array(
        F.struct(F.col(out).alias("p"), F.col(BITS).alias("now"), F.lit(None).cast(kind).alias("before")),
        F.struct(next_period.alias("p"), F.lit(None).cast(kind).alias("now"), F.col(BITS).alias("before")),
    )
    pairs = by_period.select(*keys, BUCKET, F.inline(sides))
    merged = pairs.groupBy(*keys, "p", BUCKET).agg(
        merge("now").alias("now"),
        merge("before").alias("before"),
        merge(F.coalesce("now", "before")).alias("either"),
    )
    counts = merged.groupBy(*keys, F.col("p").alias(out)).agg(
        *[F.sum(F.coalesce(count(c), F.lit(0))).alias(f"_{c}") for c in ("now", "before", "either")]
    )
    return counts.select(
        *keys,
        out,
        F.col("_now").alias("active"),
        (F.col("_now") + F.col("_before") - F.col("_either")).alias("retained"),
        (F.col("_either") - F.col("_before")).alias("arrived"),
        (F.col("_either") - F.col("_now")).alias("lost"),
    )
