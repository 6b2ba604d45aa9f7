"""Small numeric expressions shared by the aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_if_positive(numerator: Column, divisor: Column) -> Column:
    """``numerator / divisor`` where the divisor is above zero, else NULL."""
    return F.when(divisor > 0, numerator / divisor)


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent; NULL where the whole is zero."""
    return F.try_divide(part, whole) * 100


def label_below(value: Column, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step the value is below; NULL and large values get ``otherwise``."""
    ladder = None
    for limit, label in steps:
        hit = value < limit
        ladder = F.when(hit, label) if ladder is None else ladder.when(hit, label)
    return F.lit(otherwise) if ladder is None else ladder.otherwise(otherwise)
