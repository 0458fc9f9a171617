"""CASE expressions: classes by threshold and activity state labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Class names with the rating each must exceed, and the class below all.
QUALITY_THRESHOLDS = [("star", 8.0), ("good", 7.0), ("average", 6.0)]
QUALITY_FLOOR = "bad"

# The labels of the activity states.
NEW = "New"
RETIRED = "Retired"
RETURNED = "Returned From Retired"
CONTINUED = "Continued Playing"
STAYED_RETIRED = "Stayed Retired"
UNKNOWN = "Unknown"


def classify(value: Column, thresholds: Sequence[tuple[str, float]], floor: str) -> Column:
    """First class whose threshold ``value`` exceeds; ``floor`` if none, also for NULL."""
    result = F.lit(floor)
    for name, bound in reversed(thresholds):
        result = F.when(value > F.lit(bound), F.lit(name)).otherwise(result)
    return result


def activity_state(was_active: Column, is_active: Column) -> Column:
    """Label of a change between two known activity flags; NULL if either is unknown."""
    return F.when(
        was_active, F.when(is_active, F.lit(CONTINUED)).when(~is_active, F.lit(RETIRED))
    ).when(
        ~was_active, F.when(is_active, F.lit(RETURNED)).when(~is_active, F.lit(STAYED_RETIRED))
    )


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
