"""Joins whose keys may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def full_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join under which NULL keys are equal to each other; one column per key.

    The other columns of the two sides must have different names. A table that is stepped on
    by such joins keeps one row for a NULL key, where a plain join adds one at each step.
    """
    others = [c for c in right.columns if c not in keys]
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *others)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, "full").select(
        *[F.coalesce(k, f"_right_{k}").alias(k) for k in keys],
        *[c for c in left.columns if c not in keys],
        *others,
    )
