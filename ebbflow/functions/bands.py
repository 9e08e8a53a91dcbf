"""Banding of numbers and codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbflow.settings import (
    AGE_BANDS,
    MIN_AGE,
    MINIMUM_WAGE,
    OLDEST_BAND,
    SALARY_BANDS,
    TOP_SALARY_BAND,
    UNKNOWN,
)


def stepped_band(value: Column, steps: Iterable[tuple[float, str]], above: str) -> Column:
    """Label of the first step whose inclusive upper bound is not exceeded."""
    (first_bound, first_label), *rest = steps
    chain = F.when(value <= first_bound, first_label)
    for bound, label in rest:
        chain = chain.when(value <= bound, label)
    return chain.otherwise(above)


def age_band(age: Column) -> Column:
    """Age band; null or below the legal minimum is unknown."""
    known = stepped_band(age, AGE_BANDS, OLDEST_BAND)
    return F.when(age >= MIN_AGE, known).otherwise(UNKNOWN)


def salary_band(salary: Column, minimum_wage: float = MINIMUM_WAGE) -> Column:
    """Band in minimum wages; a missing or non-positive salary counts as the lowest."""
    steps = [(multiple * minimum_wage, label) for multiple, label in SALARY_BANDS]
    return stepped_band(F.coalesce(salary, F.lit(0.0)), steps, TOP_SALARY_BAND)


def volume_band(count: Column, edges: tuple[int, int], labels: tuple[str, str, str]) -> Column:
    small, medium, large = labels
    return stepped_band(count, [(edges[0], small), (edges[1], medium)], large)


def leading_digits(code: Column, digits: int = 2) -> Column:
    """Group of a hierarchical code: its first digits."""
    return F.substring(code.cast("string"), 1, digits)
