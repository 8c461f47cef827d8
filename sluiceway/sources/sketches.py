"""Which stored parts may hold a key: split-block Bloom filters kept as rows, built and asked with column functions.

A filter has a power of two of blocks.  A block is eight words of 32 bits, and a key sets one bit in each word of one
block.  Every block is a row, so the filter of a part of any size is one aggregate, spread over as many tasks as
that takes, and asking it is a join on the block: no filter is ever held as a whole.  Four bytes a key are stored; a
key that is not there is taken for present in about one of 100,000 cases per part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.session import broadcast_bounded

KEYS_PER_BLOCK = 8
RUN_BITS = 16  # 2^16 blocks, 2 MB of a filter, are written by one task
_WORDS = [f"w{i}" for i in range(8)]
BLOCK_COLUMNS = "blocks bigint, block bigint, " + ", ".join(f"{w} int" for w in _WORDS)
_ASKED_BYTES = 48


def _block(key: Column, blocks: Column) -> Column:
    return F.xxhash64(F.lit("block"), key).bitwiseAND(blocks - 1)


def _bits(key: Column) -> dict[str, Column]:
    """The bit a key has in each word of its block."""
    hashed = F.xxhash64(key)
    place = {w: F.shiftright(hashed, 5 * i).bitwiseAND(31).cast("int") for i, w in enumerate(_WORDS)}
    return {w: F.call_function("shiftleft", F.lit(1), p) for w, p in place.items()}


def key_filters(rows: DataFrame, key: Column, groups: list[str], sizes: DataFrame) -> DataFrame:
    """The filter of each group of rows over its non-null keys; `sizes` has the `rows` of each group."""
    least = F.greatest(F.col("rows") / KEYS_PER_BLOCK, F.lit(1.0))
    blocks = F.pow(F.lit(2.0), F.ceil(F.log2(least))).cast("bigint")
    keyed = rows.select(*groups, key.alias("_key")).where("_key IS NOT NULL")
    # One row per group: joined by a shuffle, all keys of a group would meet in one task.
    sized = keyed.join(F.broadcast(sizes.select(*groups, blocks.alias("blocks"))), groups)
    placed = sized.select(*groups, "blocks", _block(F.col("_key"), F.col("blocks")).alias("block"), *[b.alias(w) for w, b in _bits(F.col("_key")).items()])
    return placed.groupBy(*groups, "blocks", "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])


def together(blocks: DataFrame, groups: list[str]) -> DataFrame:
    """Blocks gathered for writing by group, those of a large filter in runs, each by a task."""
    return blocks.withColumn("_run", F.shiftright("block", RUN_BITS)).hint("rebalance", *groups, "_run").drop("_run")


def groups_that_may_hold(filters: DataFrame, groups: list[str], keys: DataFrame, rows: int) -> DataFrame:
    """The groups whose filter has at least one of the keys, the only column of `keys`; there are at most `rows` of them.

    Filters differ in their number of blocks, which is a power of two, so a key is asked for once per power that occurs.
    """
    sizes = [r.blocks for r in filters.select("blocks").distinct().collect()]
    if not sizes:
        return filters.select(*groups)
    key = F.col(f"`{keys.columns[0]}`")
    per_size = keys.where(key.isNotNull()).select(key.alias("_key"), F.explode(F.array(*[F.lit(n).cast("bigint") for n in sizes])).alias("blocks"))
    asked = per_size.select(
        F.col("blocks").alias("_blocks"), _block(F.col("_key"), F.col("blocks")).alias("_block"), *[b.alias(f"_{w}") for w, b in _bits(F.col("_key")).items()]
    )
    asked = broadcast_bounded(asked, rows * len(sizes), _ASKED_BYTES)
    match = (F.col("blocks") == F.col("_blocks")) & (F.col("block") == F.col("_block"))
    for w in _WORDS:
        match &= F.col(w).bitwiseAND(F.col(f"_{w}")) != 0
    return filters.join(asked, match, "left_semi").select(*groups).distinct()
