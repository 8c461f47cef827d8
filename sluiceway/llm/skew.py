"""Attach per-group facts to rows when one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.session import BROADCAST_LIMIT_BYTES, ROW_OVERHEAD_BYTES, fits_broadcast


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, row_bytes: int) -> DataFrame:
    """Left join of `rows` with the small-per-group table `groups` on `key`.

    If the counted groups prove small, they go to every task and no row moves.  Otherwise groups large
    enough to skew a shuffle go to every task (there can be only total / threshold of them, and the
    threshold is chosen so that they fit), and only rows of the other groups are shuffled.
    """
    count = groups.count()
    if fits_broadcast(count, row_bytes):
        return rows.join(F.broadcast(groups), key, "left")
    total = groups.agg(F.sum(size)).first()[0]
    room = BROADCAST_LIMIT_BYTES // (row_bytes + ROW_OVERHEAD_BYTES)
    threshold = max(10_000, total // room + 1)
    hot = groups.where(F.col(size) > threshold)
    facts = [c for c in groups.columns if c != key]
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    rest = marked.where("_hot IS NULL").drop("_hot", *facts)
    cold = rest.join(groups.where(F.col(size) <= threshold), key, "left")
    return marked.where("_hot").drop("_hot").unionByName(cold)
