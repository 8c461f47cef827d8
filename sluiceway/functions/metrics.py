"""Builders of check metrics: each returns one aggregate that counts offending rows.

A builder never triggers work; any number of them goes into a single `agg`.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """A metric, where it comes from, and the closed range it has to fall into.

    `metric` is an aggregate for the fused pass, or None if the value is worked
    out elsewhere (a join, a second table).  A bound of None is open.
    """

    name: str
    category: str
    metric: Column | None = None
    low: float | None = 0
    high: float | None = 0
    detail: str = "metrics"


def null_count(value: Column) -> Column:
    return F.count_if(value.isNull())


def bad_format(value: Column, well_formed: Column) -> Column:
    """Present values that are not well formed."""
    return F.count(value) - F.count_if(value.isNotNull() & well_formed)


def only_characters(value: Column, allowed: str) -> Column:
    """True if nothing is left after deleting the allowed characters."""
    return F.length(F.translate(value, allowed, "")) == 0


def bad_cast(value: Column, converted: Column) -> Column:
    """Present values that do not convert."""
    return F.count_if(value.isNotNull() & converted.isNull())


def not_in(value: Column, allowed: Iterable[str]) -> Column:
    """Present values outside the list; NULL belongs to completeness."""
    return F.count_if(~value.isin(list(allowed)))


def out_of_range(value: Column, above: float, at_most: float) -> Column:
    return F.count_if((value <= F.lit(above)) | (value > F.lit(at_most)))


def missing_any(values: Iterable[Column]) -> Column:
    """Rows in which at least one value is absent."""
    return F.count_if(reduce(lambda a, b: a | b, [v.isNull() for v in values]))


def bad_derived(value: Column, expected: Column) -> Column:
    return F.count_if(value != expected)


def row_count() -> Column:
    return F.count(F.lit(1))


def age_seconds(latest: Column, as_of: Column) -> Column:
    """Seconds between the latest timestamp of the group and `as_of`."""
    return F.timestamp_diff("SECOND", F.max(latest), as_of)
