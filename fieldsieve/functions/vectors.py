"""Expressions over score and embedding arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax(scores: Column) -> Column:
    """0-based place of the largest score; the first one wins a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def squared_distance(vector: Column, center: Sequence[float]) -> Column:
    """Squared Euclidean distance to a fixed ``center``, summed from the first place on."""
    total = F.lit(0.0)
    for place, value in enumerate(center):
        gap = vector[place].cast("double") - F.lit(float(value))
        total = total + gap * gap
    return total


def clipped_label(label: Column, low: int = 0, high: int = 5) -> Column:
    """``label`` cut to a whole number (toward zero) and then to ``[low, high]``."""
    return F.least(F.greatest(label.cast("int"), F.lit(low)), F.lit(high))


def rounded_label(label: Column) -> Column:
    """``label`` rounded half to even."""
    return F.rint(label).cast("int")
