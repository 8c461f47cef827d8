"""Questions about keys: repeats, repeats across batches, missing references, latest row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sluiceway.functions.metrics import Check
from sluiceway.operators.profile import key_counts
from sluiceway.session import fits_broadcast


@dataclass(frozen=True)
class KeyBounds:
    """What the profiling pass learned about a batch's keys."""

    rows: int
    longest: int
    low: str | None
    high: str | None

    @staticmethod
    def metrics(key: str) -> list[Check]:
        """Aggregates to put into the fused pass; they are not judged."""
        return [
            Check("KEY_LONGEST", "", F.coalesce(F.max(F.octet_length(key)), F.lit(0))),
            Check("KEY_LOW", "", F.min(key)),
            Check("KEY_HIGH", "", F.max(key)),
        ]

    @staticmethod
    def of(rows: int, profile: Row) -> KeyBounds:
        return KeyBounds(rows, profile.KEY_LONGEST, profile.KEY_LOW, profile.KEY_HIGH)


def key_metrics(
    current: DataFrame, history: DataFrame | None, key: str, bounds: KeyBounds, duplicates: str, repeats: str
) -> DataFrame:
    """One row: surplus rows per key in `current`, and its rows whose key `history` also holds.

    History keys outside the batch's range are dropped in the scan; with growing
    ids that leaves nothing to shuffle.  Of the rest, if the current keys are
    proven small they go to the executors and only hits are shuffled; otherwise
    both sides are reduced to distinct keys before they meet.
    """
    mine = key_counts(current, key)
    if history is None:
        return mine.agg((F.sum("_n") - F.count(key)).alias(duplicates), F.lit(0).cast("bigint").alias(repeats))
    theirs = history.select(key).where(F.col(key).between(bounds.low, bounds.high))
    if fits_broadcast(bounds.rows, bounds.longest):
        theirs = theirs.join(F.broadcast(mine.select(key)), key, "left_semi")
    seen = theirs.distinct().withColumn("_seen", F.lit(True))
    return mine.join(seen, key, "left").agg(
        (F.sum("_n") - F.count(key)).alias(duplicates),
        F.coalesce(F.sum(F.when(F.col("_seen"), F.col("_n"))), F.lit(0)).alias(repeats),
    )


def repeats_across(rows: DataFrame, key: str, part: str) -> DataFrame:
    """For every part: rows whose key also occurs in another part.

    Rows are first counted per (part, key), so the window sees at most one row
    per part for any key, however frequent the key is.
    """
    counted = key_counts(rows.where(F.col(key).isNotNull()), key, [part])
    same_key = Window.partitionBy(key)
    shared = F.min(part).over(same_key) < F.max(part).over(same_key)
    return (
        counted.withColumn("_shared", shared)
        .groupBy(part)
        .agg(F.sum(F.when(F.col("_shared"), F.col("_n")).otherwise(0)).alias("repeats"))
    )


def missing_references(rows: DataFrame, key: str, reference: DataFrame, reference_key: str) -> DataFrame:
    """Distinct keys without a partner; NULL counts as one of them.

    No broadcast hint: Spark broadcasts the reference if its measured size allows.
    """
    wanted = rows.select(key).distinct()
    known = reference.select(F.col(reference_key).alias(key))
    return wanted.join(known, key, "left_anti")


def keys_without_origin(rows: DataFrame, origin: DataFrame, key: str) -> DataFrame:
    """Distinct key values of `rows` that `origin` never had (provenance)."""
    return rows.select(key).distinct().join(origin.select(key).distinct(), key, "left_anti")


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by `order`.

    Spark turns `rank == 1` into a group limit ahead of the shuffle: a task sends
    at most one row per key, so a key with very many copies does not pile up.
    """
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest_part(rows: DataFrame, part: str, loaded_at: str) -> DataFrame:
    """The part with the newest load time, ties by name; one row per task is moved."""
    newest = F.max_by(part, F.struct(loaded_at, part))
    return rows.agg(newest.alias(part), F.max(loaded_at).alias("latest_load"))
