"""Small column expressions shared by the feature jobs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def flag(condition: Column) -> Column:
    """INT 1 where the condition holds, 0 where it is false or NULL."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def ratio(numerator: Column, denominator: Column, otherwise: float | Column = 0.0) -> Column:
    """Quotient for a positive denominator; zero, negative and NULL denominators give ``otherwise``."""
    fallback = otherwise if isinstance(otherwise, Column) else F.lit(float(otherwise))
    return F.when(denominator > 0, numerator / denominator).otherwise(fallback)


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100


def change(now: Column, before: Column) -> Column:
    """Difference to the previous value, 0 when there is none."""
    return F.when(before.isNull(), F.lit(0.0)).otherwise(now - before)


def percent_change(now: Column, before: Column) -> Column:
    return percent(now - before, before)


def _pick(branches: Sequence[tuple[Column, object]], rest: object) -> Column:
    start, *more = branches
    return reduce(lambda done, b: done.when(b[0], F.lit(b[1])), more, F.when(start[0], F.lit(start[1]))).otherwise(F.lit(rest))


def by_floor(value: Column, steps: Sequence[tuple]) -> Column:
    """Label of the first (highest) floor reached; the last step is the rest."""
    return _pick([(value >= floor, label) for floor, label in steps[:-1]], steps[-1][1])


def by_ceiling(value: Column, steps: Sequence[tuple]) -> Column:
    """Label of the first (lowest) ceiling not reached; the last step is the rest."""
    return _pick([(value < ceiling, label) for ceiling, label in steps[:-1]], steps[-1][1])


def first_true(conditions: Sequence[Column], labels: Sequence) -> Column:
    """Label of the first condition that holds; the last label is the rest."""
    return _pick(list(zip(conditions, labels)), labels[-1])


def in_bucket(value: Column, rules: Sequence[tuple], closed: str = "left") -> Column:
    """Label of the ``(label, min, max)`` rule holding the value: ``[min, max)`` or, closed="both", ``[min, max]``.
    Values outside every rule give NULL."""
    if closed not in ("left", "both"):
        raise ValueError("closed is 'left' or 'both'")
    branches = []
    for label, low, high in rules:
        inside = value >= low
        if high != float("inf"):
            inside = inside & ((value < high) if closed == "left" else (value <= high))
        branches.append((inside, label))
    return _pick(branches, None)
