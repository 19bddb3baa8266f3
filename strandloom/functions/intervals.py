"""Column functions on closed 1-based intervals and on counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def overlap_length(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """shared positions of two closed intervals, 0 if there are none."""
    return F.greatest(F.lit(0), F.least(end, other_end) - F.greatest(start, other_start) + 1)


def overlaps(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Whether two closed intervals share a position."""
    return (start <= other_end) & (end >= other_start)


def before(end: Column, other_start: Column) -> Column:
    """Whether the first interval ends before the second starts."""
    return end < other_start


def after(start: Column, other_end: Column) -> Column:
    """Whether the first interval starts after the second ends."""
    return start > other_end


def overlap_ratio(start: Column, end: Column, other_start: Column, other_end: Column) -> Column:
    """Share of the first interval that the second covers."""
    return overlap_length(start, end, other_start, other_end) / (end - start + 1)


def safe_divide(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or either is null."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def fraction(c: Column, t: Column) -> Column:
    """C / (c + t), 0 without any."""
    return safe_divide(c, c + t)


def log2_ratio(a: Column, b: Column) -> Column:
    """log2(a / b), NaN unless both are above 0."""
    return F.when((a > 0) & (b > 0), F.log2(a / b)).otherwise(F.lit(float("nan")))


def reversed_coordinate(x: Column, length: Column) -> Column:
    """the same position counted from the other end."""
    return length - x + 1


def same(a: Column, b: Column) -> Column:
    """Equality in which two nulls are equal, letters of either case too."""
    return F.lower(a).eqNullSafe(F.lower(b))


def bound(text: Column) -> Column:
    """a number, or an infinity for -inf and inf (any case); null for anything else."""
    low = F.lower(F.trim(text))
    return F.when(low == "-inf", F.lit(float("-inf"))).when(low.isin("inf", "+inf"), F.lit(float("inf"))).otherwise(text.try_cast("double"))
