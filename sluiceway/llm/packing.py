"""Padded batches from optimal length buckets.

The global length histogram goes through dynamic programming, which chooses the bucket bounds with the least
padding; inside each bucket, batches of a fixed token budget are numbered without gaps.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluiceway.llm.graph import store
from sluiceway.llm.text import words

BUCKETS = 8
BATCH_TOKENS = 32_768
CHUNK_ROWS = 10_000
PRECISION_BITS = 12


def rounded_length(n: Column) -> Column:
    """Length rounded up to 12 significant bits: exact up to 8,192, then by at most 1/4,096.

    So the histogram has at most 4,096 entries for each doubling of the longest text.
    """
    bits = F.greatest(F.length(F.bin(n)) - F.lit(PRECISION_BITS + 1), F.lit(0))
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
    return (F.ceil(n / unit) * unit).cast("long")


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper bounds of at most `buckets` length ranges with the least total padding.

    `lengths` ascend.  Of equally good choices the one with the smallest last bounds is taken.
    """
    size = len(lengths)
    if size == 0:
        return []
    lengths, total = lengths.astype(np.int64), np.concatenate(([0], np.cumsum(counts.astype(np.int64))))
    # cost[j]: padded tokens of the first j lengths; unpadded tokens are the same for every choice.
    cost = np.concatenate(([0], lengths * total[1:]))
    cuts = []
    for _ in range(min(buckets, size) - 1):
        new, cut = cost.copy(), np.zeros(size + 1, np.int64)
        for j in range(1, size + 1):
            options = cost[:j] + lengths[j - 1] * (total[j] - total[:j])
            cut[j] = int(np.argmin(options))
            new[j] = options[cut[j]]
        cost = new
        cuts.append(cut)
    bounds, j = [], size
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(lengths[j - 1]))
        j = int(cut[j])
    if j > 0:
        bounds.append(int(lengths[j - 1]))
    return sorted(set(bounds))


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS,
) -> DataFrame:
    """Per input row: id, n_tokens, bucket_length, batch, slot.

    (bucket_length, batch) names a batch of rows padded to bucket_length; rows x bucket_length is at most
    `batch_tokens`, but for a single text longer than that.  Batches are full except the last of a bucket.

    A token is a word; null and empty texts have none and go to the shortest bucket.  Rows are ordered by
    an md5 of their id, so ties are broken by length only and repeated rows are interchangeable.  An empty table gives
    no batches.  Only aggregated lengths and chunk sizes are looked at globally.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.size(words(F.col(text_col))).cast("long").alias("n_tokens"))
    rows = store(rows.withColumn("length", rounded_length(F.col("n_tokens"))), "lengths")
    histogram = rows.groupBy("length").count().collect()  # bounded, see rounded_length
    histogram = sorted((r["length"], r["count"]) for r in histogram)
    lengths = np.array([x for x, _ in histogram], np.int64)
    counts = np.array([c for _, c in histogram], np.int64)
    bounds = best_bounds(lengths, counts, buckets)
    bucket, chunks, capacity = F.lit(None).cast("long"), F.lit(1).cast("long"), F.lit(1).cast("long")
    for i in reversed(range(len(bounds))):
        inside = (lengths <= bounds[i]) & (lengths > (bounds[i - 1] if i else -1))
        here = F.col("length") <= bounds[i]
        bucket = F.when(here, F.lit(bounds[i]).cast("long")).otherwise(bucket)
        chunks = F.when(here, F.lit(int(-(-counts[inside].sum() // CHUNK_ROWS))).cast("long")).otherwise(chunks)
        capacity = F.when(here, F.lit(max(1, batch_tokens // max(1, bounds[i]))).cast("long")).otherwise(capacity)
    key = F.md5(F.concat_ws("|", F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("n_tokens").cast("string")))
    number = F.conv(F.substring("key", 1, 15), 16, 10).cast("long")
    rows = rows.select("id", "n_tokens", key.alias("key"), bucket.alias("bucket_length"), chunks.alias("chunks"), capacity.alias("capacity"))
    rows = rows.withColumn("chunk", F.pmod(number, "chunks"))
    earlier = Window.partitionBy("bucket_length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("bucket_length", "chunk").count()
    sizes = sizes.select("bucket_length", "chunk", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket_length", "chunk").orderBy("key")
    placed = rows.join(sizes, ["bucket_length", "chunk"])
    at = F.row_number().over(inside) - 1 + F.col("before")
    return placed.withColumn("at", at).select(
        F.col("id").alias(id_col), "n_tokens", "bucket_length",
        F.floor(F.col("at") / F.col("capacity")).alias("batch"), (F.col("at") % F.col("capacity")).cast("long").alias("slot"),
    )
