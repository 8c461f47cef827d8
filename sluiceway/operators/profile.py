"""Fused profiling: many metrics of a table in one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.metrics import Check


def fused_metrics(rows: DataFrame, checks: Sequence[Check], by: Sequence[str] = ()) -> DataFrame:
    """Every check that has a metric, in one scan; one row, or one per `by` group.

    None of the metrics is distinct, so each task reduces its input to one row per
    group and only those rows are shuffled.
    """
    return rows.groupBy(*by).agg(*[c.metric.alias(c.name) for c in checks if c.metric is not None])


def key_counts(rows: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per key.  Counted before the shuffle, so a frequent key is one row per task."""
    return rows.groupBy(*by, key).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_metric(rows: DataFrame, key: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows minus distinct keys; a NULL key adds to the difference.

    Kept apart from the fused pass: it needs a shuffle by key, and that shuffle
    should carry a key and a count, not a row of every metric's partial result.
    """
    return key_counts(rows, key, by).groupBy(*by).agg((F.sum("_n") - F.count(key)).alias(name))


def attach(metrics: DataFrame, more: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Put metrics of the same groups side by side; both have one row per group.

    Without groups `more` is one row, and each of its values becomes a scalar subquery.
    """
    if not by:
        return metrics.select("*", *[more.select(c).scalar().alias(c) for c in more.columns])
    return metrics.join(more, list(by), "left")


def batch_profile(rows: DataFrame, batch: str, key: str, loaded_at: str, others: Sequence[str] = ()) -> DataFrame:
    """Per batch: rows, distinct keys, first and last load time, distinct values of other columns.

    Every distinct count is reduced inside the tasks in a pass of its own.
    """
    profile = (
        rows.groupBy(batch, key)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(loaded_at).alias("_lo"), F.max(loaded_at).alias("_hi"))
        .groupBy(batch)
        .agg(
            F.sum("_n").alias("total_rows"),
            F.count(key).alias("distinct_keys"),
            F.min("_lo").alias("earliest_load"),
            F.max("_hi").alias("latest_load"),
        )
    )
    for column in others:
        members = rows.select(batch, column).distinct().groupBy(batch).agg(F.count(column).alias(f"distinct_{column}"))
        profile = profile.join(members, batch, "left")
    return profile


def distinct_count(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Exact number of distinct non-null values; reads one column."""
    return rows.select(column).distinct().agg(F.count(column).alias(name))


def load_profile(rows: DataFrame) -> DataFrame:
    """Acceptance figures of a load: rows, distinct row and key hashes, files.

    Each exact distinct count reads its own column, so together they read what one
    scan of all three would, and none of them copies rows for the others.
    """
    total = rows.agg(F.count(F.lit(1)).alias("total_rows"))
    for column, name in [
        ("ROW_HASH_ID", "distinct_row_hash"),
        ("UNIQUE_HASH_ID", "distinct_unique_hash"),
        ("_FILENAME", "files"),
    ]:
        total = attach(total, distinct_count(rows, column, name))
    return total
