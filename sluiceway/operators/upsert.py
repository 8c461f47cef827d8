"""Keyed upsert: a new row replaces the old one with the same key, others stay."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.keys import latest_per_key
from sluiceway.session import delete_path, fits_broadcast
from sluiceway.sources.tables import PartTable, require_same_schema


def upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """The target after the upsert, as one lazy plan.

    `order` decides between source rows of one key; without it the source must
    already be unique.
    """
    require_same_schema(target.schema, source.schema)
    kept = target.join(source.select(*keys).distinct(), list(keys), "left_anti").select(target.columns)
    return kept.unionByName(latest_per_key(source, keys, order) if order else source)


@dataclass(frozen=True)
class Merged:
    """What a merge did: the version and rows that came in, the rows they replaced, the parts written for it."""

    version: str
    fresh: DataFrame
    replaced: DataFrame
    rewritten: list[str]
    arriving: list[str]


def merge_into(
    table: PartTable,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
    carry: Sequence[str] = (),
    age: str | None = None,
    ready: Callable[[Merged], None] | None = None,
) -> Merged | None:
    """Upsert into a stored table, rewriting only the parts that hold a replaced row.

    The incoming rows are stored first, so everything after works from their columns on disk.  Replaced
    rows are looked for once, between the smallest and largest incoming key, reading key, part and
    `carry` columns; what is found is stored.  Parts without a match are neither read in full nor written.
    With `age`, an incoming row does not replace one with a larger value in that column.  `ready` is
    called with the merge before anything shows.  None if there was nothing to merge.  Into an empty table nothing is
    looked for.  `forget_merge` deletes what was found, when it has been used.
    """
    keys, spark = list(keys), table.spark
    before, live = table.read(), set(table.live_parts())
    staged = table.write(latest_per_key(source, keys, order) if order else source)
    fresh, orphans = table.stored(staged).select(before.columns), []
    columns = list(dict.fromkeys([*keys, table.part, *carry, *([age] if age else [])]))
    at = f"{table.path}/merges/{staged}"
    if live:
        _hits(table, fresh, keys, columns).write.parquet(at)
        hits = spark.read.schema(before.select(columns).schema).parquet(at)
    else:  # nothing to replace
        hits = spark.createDataFrame([], before.select(columns).schema)
    if age and live:
        mine = fresh.select(*keys, F.col(age).alias("_age"))
        newer = hits.join(mine, keys).where(F.col(age) > F.col("_age")).select(*keys)
        if not newer.isEmpty():  # late rows: store what is left of the source
            orphans.append(staged)
            staged = table.write(fresh.join(newer, keys, "left_anti").select(before.columns))
            fresh = table.stored(staged).select(before.columns)
            hits = hits.join(fresh.select(*keys), keys, "left_semi")
    # Part names only, here and below: at most one per part of the table.
    arriving = _parts(fresh, table.part)
    if not arriving:
        return None
    touched = (_parts(hits, table.part) if live else set()) | (live & arriving)
    merged = Merged(staged, fresh, hits, sorted(touched), sorted(arriving))
    if ready:
        ready(merged)
    kept = before.where(F.col(table.part).isin(sorted(touched))).join(fresh.select(*keys), keys, "left_anti")
    if touched & arriving:
        # A part shows one version, so old and new rows of it go into the same one.
        table.replace(kept.select(before.columns).unionByName(fresh), drop=touched, spread=True)
    elif touched:
        table.publish([staged, table.write(kept, spread=True)], drop=touched)
    else:
        table.publish([staged])
    for version in orphans:
        table.forget(version)
    return merged


def forget_merge(table: PartTable, version: str) -> None:
    """Delete the looked-up rows of a merge once nobody needs them."""
    delete_path(table.spark, f"{table.path}/merges/{version}")


def _hits(table: PartTable, fresh: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Named columns, the keys among them, of the stored rows whose key comes in.

    Few keys are first looked up in the filters of the table, if it has them, so that only parts that may hold one are read.
    """
    first, wanted = keys[0], table.read().select(*columns)
    found = fresh.agg(F.min(first), F.max(first), F.count(F.lit(1)), F.max(F.octet_length(F.col(first).cast("string")))).first()
    low, high, rows, longest = found
    if low is not None and table.key is not None and len(keys) == 1 and fits_broadcast(rows, longest):
        wanted = table.read(table.may_hold(fresh.select(table.key), rows)).select(*columns)
    if low is not None:
        wanted = wanted.where(F.col(first).between(low, high))
    return wanted.join(fresh.select(*keys), keys, "left_semi")


def _parts(rows: DataFrame, part: str) -> set[str]:
    return {r[0] for r in rows.select(part).distinct().collect()}
