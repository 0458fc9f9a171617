"""Array expressions: newest-first lists, day-indexed arrays and bitmaps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .dates import as_column

LOW_32_BITS = (1 << 32) - 1


def prepend(value: Column, items: Column) -> Column:
    """``value`` put before ``items``; a missing side leaves the other as it is."""
    return (
        F.when(items.isNull(), F.array(value))
        .when(value.isNull(), items)
        .otherwise(F.concat(F.array(value), items))
    )


def place_at(items: Column, index: Column, value: Column) -> Column:
    """``items`` with ``value`` at a zero-based index; every gap becomes 0.

    The array grows to reach the index and never shrinks, so placing the same value
    twice changes nothing.
    """
    size = F.coalesce(F.size(items), F.lit(0))
    last = F.greatest(size, index + 1) - 1
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.when(i == index, F.coalesce(value, F.lit(0))).otherwise(
            F.coalesce(F.get(items, i), F.lit(0))
        ),
    )


def spread_by_index(entries: Column, field: str, length: Column) -> Column:
    """Array of ``length`` values from structs ``(index, <field>)``; every gap is 0."""
    by_index = F.map_from_entries(F.transform(entries, lambda e: F.struct(e["index"], e[field])))
    return F.transform(
        F.sequence(F.lit(0), length - 1),
        lambda i: F.coalesce(F.try_element_at(by_index, i), F.lit(0).cast("bigint")),
    )


def day_bits(days: Column | str, as_of: Column, window: int, top_exponent: int) -> Column:
    """Bitmap of the last ``window`` days: a day ``n`` days ago sets bit ``top - n``.

    Bits are combined with OR, so a day listed twice counts once, and only the low 32
    bits are kept.
    """
    one = F.lit(1).cast("bigint")
    zero = F.lit(0).cast("bigint")

    def add(bits: Column, day: Column) -> Column:
        ago = F.datediff(as_of, day)
        bit = F.call_function("shiftleft", one, F.lit(top_exponent) - ago)
        return bits.bitwiseOR(F.when(ago.between(0, window - 1), bit).otherwise(zero))

    return F.aggregate(as_column(days), zero, add).bitwiseAND(F.lit(LOW_32_BITS))


def days_mask(first: int, last: int, top_exponent: int = 31) -> int:
    """The bits of the days ``first`` to ``last`` ago in an activity map."""
    return sum(1 << (top_exponent - n) for n in range(first, last + 1))


def active_between(bits: Column, first: int, last: int) -> Column:
    """Whether an activity map has a day from ``first`` to ``last`` days ago."""
    return bits.bitwiseAND(F.lit(days_mask(first, last))) != 0


def active_days(bits: Column, first: int, last: int) -> Column:
    """How many of the days from ``first`` to ``last`` ago are in an activity map."""
    return F.bit_count(bits.bitwiseAND(F.lit(days_mask(first, last))))


def bit_text(bits: Column, width: int = 32) -> Column:
    """Bits as text, highest first."""
    return F.lpad(F.bin(bits), width, "0")


def last_item(items: Column) -> Column:
    """Last array element; NULL for an empty array."""
    return F.try_element_at(items, F.lit(-1))
