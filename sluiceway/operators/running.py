"""Running sums per group, also for groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from sluiceway.session import broadcast_bounded, ensure_checkpoint_dir

# A group with more rows than this is summed block by block.
LARGE_GROUP_ROWS = 5_000_000
_GROUP_BYTES = 256


def running_sum(
    rows: DataFrame,
    group: str,
    order: Sequence[str],
    amount: str,
    name: str,
    large: int = LARGE_GROUP_ROWS,
    block: int | None = None,
    most: int | None = None,
) -> DataFrame:
    """Sum of `amount` from the start of the group to the current row.

    Only exact types are summed, so that both ways below give the same.  `most` is a known bound on
    the rows of a group; if it is small, the rows are not counted.

    `order` must identify a row within its group.  Ordinary groups take one window.
    Groups above `large` rows are cut into ordered blocks of about `block` rows (the
    same if not given); see `_blockwise`.  One scan of the group column decides which are which.
    """
    if isinstance(rows.schema[amount].dataType, (DoubleType, FloatType)):
        raise TypeError(f"{amount} is inexact: its running sum would depend on the way it is cut")
    if most is not None and most <= large:
        return _windowed(rows, [group], order, amount, name)
    big = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > large)
    # At most (rows / large) groups can be that big.
    found = [(r[0], r[1]) for r in big.collect()]
    if not found:
        return _windowed(rows, [group], order, amount, name)
    key_type = rows.schema[group].dataType.simpleString()
    listed = rows.sparkSession.createDataFrame([(g,) for g, _ in found], f"_big {key_type}")
    listed = broadcast_bounded(listed, len(found), _GROUP_BYTES)
    is_big = F.col(group).eqNullSafe(F.col("_big"))
    small = _windowed(rows.join(listed, is_big, "left_anti"), [group], order, amount, name)
    blocks = ceil(sum(n for _, n in found) / (block or large))
    return small.unionByName(
        _blockwise(rows.join(listed, is_big, "left_semi"), group, order, amount, name, blocks)
    )


def _windowed(rows: DataFrame, groups: Sequence[str], order: Sequence[str], amount: str, name: str) -> DataFrame:
    frame = Window.partitionBy(*groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.sum(amount).over(frame))


def _blockwise(
    rows: DataFrame, group: str, order: Sequence[str], amount: str, name: str, blocks: int
) -> DataFrame:
    """Range-partition by (group, order), sum inside each block, add what came before.

    Block borders come from a sample, so they are fixed by a checkpoint before they
    are used twice.  Totals per (group, block) are few: a block border falls into a
    group at most once per block.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    placed = (
        rows.repartitionByRange(max(blocks, 2), group, *order)
        .withColumn("_block", F.spark_partition_id())
        .checkpoint()
    )
    earlier = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(group, "_block").agg(F.sum(amount).alias("_total"))
    offsets = totals.select(
        F.col(group).alias("_group"), F.col("_block").alias("_at"), F.sum("_total").over(earlier).alias("_before")
    )
    inside = _windowed(placed, [group, "_block"], order, amount, "_inside")
    here = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_block") == F.col("_at"))
    joined = inside.join(offsets, here, "left")
    return joined.withColumn(name, _add(F.col("_inside"), F.col("_before"), joined)).drop(
        "_block", "_inside", "_before", "_group", "_at"
    )


def _add(inside: Column, before: Column, frame: DataFrame) -> Column:
    """Sum that stays NULL only while no value was seen, in the type of the plain window."""
    kind = frame.schema["_inside"].dataType
    total = F.coalesce(inside, F.lit(0)) + F.coalesce(before, F.lit(0))
    return F.when(inside.isNotNull() | before.isNotNull(), total.cast(kind))
