"""Table tests that return the offending rows; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column).isNull())


def unique(rows: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    present = rows.where(F.col(column).isNotNull())
    return present.groupBy(column).agg(F.count(F.lit(1)).alias("failing_rows")).where("failing_rows > 1")


def accepted_values(rows: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Unexpected values with their number of rows."""
    odd = rows.where(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
    return odd.groupBy(column).agg(F.count(F.lit(1)).alias("failing_rows"))


def positive(rows: DataFrame, column: str) -> DataFrame:
    return rows.where(F.col(column) <= 0)


def missing_columns(rows: DataFrame, expected: Iterable[str]) -> list[str]:
    """Expected columns the table lacks, from its schema; underscore columns do not count."""
    have = {c for c in rows.columns if not c.startswith("_")}
    return sorted(set(expected) - have)


def freshness(rows: DataFrame, loaded_at: str, as_of: Column, warn: timedelta, error: timedelta) -> DataFrame:
    """Age of the newest row and the resulting state: pass, warn or error."""
    latest = rows.agg(F.max(loaded_at).alias("latest"))
    age = F.timestamp_diff("SECOND", F.col("latest"), as_of)
    late = F.when(age.isNull() | (age > error.total_seconds()), "error").when(age > warn.total_seconds(), "warn")
    return latest.withColumn("age_seconds", age).withColumn("state", late.otherwise("pass"))
