"""Mixing sources to temperature weights, realised as budgeted block permutations.

Token shares are raised to an exponent between 0 (all sources alike) and 1 (as they are).  The exponent is
narrowed until the mixture has the wanted entropy, or repeats no source more often than allowed.  Each source is
then read in whole epochs and a part of one more: documents fall into blocks of about BLOCK_ROWS,
blocks and the documents inside them are permuted per epoch, and the last epoch stops where its budget ends.

All numbers that leave Spark are sums over the table of sources.  Places are md5 texts of seed, epoch, source
and id, so the same rows give the same mixture at any partitioning.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluiceway.llm.graph import store
from sluiceway.llm.text import spare_name, words
from sluiceway.session import fits_broadcast

BLOCK_ROWS = 1000
SEED = 17
MAX_REPEATS = 2.0
CUTS = 16  # trial exponents per pass


def _exponent(sources: DataFrame, shares: tuple, budget_ratio, max_repeats, entropy) -> float:
    """Smallest exponent within the limit, by repeated division of [0, 1]; six decimals."""
    least, most = shares
    low, high = 0.0, 1.0
    while high - low > 1e-9:
        trial = [low + (high - low) * i / CUTS for i in range(CUTS + 1)]
        sums = [F.sum(F.pow("share", F.lit(a))) for a in trial]
        logs = [F.sum(F.pow("share", F.lit(a)) * F.log("share")) for a in trial]
        row = sources.agg(*[x.alias(f"c{i}") for i, x in enumerate(sums + logs)]).first()

        def fits(i: int) -> bool:
            z, s, a = row[i], row[len(trial) + i], trial[i]
            if entropy is not None:
                return math.log(z) - a * s / z <= entropy
            ratio = budget_ratio if budget_ratio is not None else z / most ** (a - 1)
            return ratio * least ** (a - 1) / z <= max_repeats

        first = next((i for i in range(len(trial)) if fits(i)), None)
        if first is None:  # not even the shares as they are
            return 1.0
        if first == 0:
            return round(trial[0], 6)
        low, high = trial[first - 1], trial[first]
    return round(high, 6)


def _md5_number(text):
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def mixing_plan(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
    budget: int | None = None, max_repeats: float = MAX_REPEATS, entropy: float | None = None, seed: int = SEED,
) -> DataFrame:
    """Per input row: id, source, n_tokens, full_epochs, copies, block.

    `budget` is the mixture's tokens; without it the mixture is just so large that every source is read at
    least once, so no document is left out.  `copies` is the number of times a row is read.

    A token is a word.  Null and empty texts have none; a source without tokens is read once.  Null is a source
    of its own.  Rows that repeat id and source share one place and are read together.  A null id is placed like an
    empty one.  An empty table gives an empty plan.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("n_tokens"),
    )
    rows = store(rows, "tokens")
    sources = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows"))
    sources = store(sources, "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    shares = store(sources.where("tokens > 0").withColumn("share", F.col("tokens") / F.lit(max(total, 1))), "shares")
    low_high = shares.agg(F.min("share"), F.max("share"), F.count("*")).first()
    alpha, z = 1.0, 1.0
    if low_high[2]:
        ratio = None if budget is None else budget / total
        alpha = _exponent(shares, low_high[:2], ratio, max_repeats, entropy)
        z = shares.agg(F.sum(F.pow("share", F.lit(alpha)))).first()[0]
        budget = budget if budget is not None else total * z / low_high[1] ** (alpha - 1)
    share = F.col("tokens") / F.lit(max(total, 1))
    target = F.lit(float(budget or 0)) * F.pow(share, F.lit(alpha)) / F.lit(z)
    full = F.when(F.col("tokens") == 0, F.lit(1)).otherwise(F.floor(target / F.col("tokens") + 1e-9)).cast("long")
    part = F.when(F.col("tokens") == 0, F.lit(0)).otherwise(F.floor(target - full * F.col("tokens") + 1e-3)).cast("long")
    quotas = sources.select(
        F.col("source").alias("s"), full.alias("full_epochs"), F.greatest(part, F.lit(0)).alias("part_tokens"),
        F.ceil(F.col("rows") / BLOCK_ROWS).cast("long").alias("blocks"),
    )
    if fits_broadcast(quotas.count(), 96):
        quotas = F.broadcast(quotas)
    place = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("id").cast("string"), F.lit("")))
    placed = rows.join(quotas, F.col("source").eqNullSafe(F.col("s"))).withColumn("block", F.pmod(_md5_number(place), "blocks"))
    epoch = F.col("full_epochs").cast("string")
    block_key = F.md5(F.concat_ws("|", F.lit(str(seed)), epoch, F.col("source"), F.col("block").cast("string")))
    doc_key = F.md5(F.concat_ws("|", epoch, place))
    blocks = placed.groupBy("s", "block", "full_epochs", "part_tokens").agg(F.sum("n_tokens").alias("block_tokens"))
    earlier = Window.partitionBy("s").orderBy("block_key").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("source", F.col("s")).withColumn("block_key", block_key)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("block_tokens").over(earlier), F.lit(0)))
    left = F.col("part_tokens") - F.col("before")  # what the last epoch has for this block
    blocks = blocks.select(F.col("s").alias("bs"), F.col("block").alias("bb"), left.alias("left"))
    same = F.col("s").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb"))
    inside = Window.partitionBy("s", "block").orderBy("doc_key")
    found = placed.withColumn("doc_key", doc_key).join(blocks, same)
    found = found.withColumn("running", F.sum("n_tokens").over(inside))
    extra = F.when((F.col("left") > 0) & (F.col("running") <= F.col("left")), 1).otherwise(0)
    return found.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "n_tokens", "full_epochs",
        (F.col("full_epochs") + extra).alias("copies"), "block",
    )


def reading_order(plan: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """One row per copy: id, source, n_tokens, epoch, block, place.  Sorting a source by (epoch, place) reads it.

    Rows that repeat id and source share a place.  A null id is placed like an empty one.  An empty plan gives no rows.
    """
    copies = plan.where("copies > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    epoch = F.col("epoch").cast("string")
    block_key = F.md5(F.concat_ws("|", F.lit(str(seed)), epoch, F.col(source_col), F.col("block").cast("string")))
    own = F.concat_ws("|", epoch, F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    return copies.select(
        id_col, source_col, "n_tokens", "epoch", "block", F.concat_ws("-", block_key, F.md5(own)).alias("place")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """`docs` with every row repeated as the plan says; columns unchanged, whatever their names.

    Null and empty texts, null sources and ids, repeated rows and an empty table are treated as in `mixing_plan`.  Rows pass
    as they are, however long: only ids and sources are looked up, and a row is read once for all its copies.
    """
    plan = mixing_plan(docs, id_col, source_col, text_col, **options).where("copies <> 1")
    own_id, own_source, times, copy = (spare_name(docs, n) for n in ("_id", "_source", "_times", "_copy"))
    plan = plan.select(F.col(id_col).alias(own_id), F.col(source_col).alias(own_source), F.col("copies").alias(times)).distinct()
    plan = store(plan, "copies")
    if fits_broadcast(plan.count(), 48):
        plan = F.broadcast(plan)
    same = docs[f"`{id_col}`"].eqNullSafe(plan[own_id]) & docs[f"`{source_col}`"].eqNullSafe(plan[own_source])
    copies = F.coalesce(plan[times], F.lit(1).cast("long"))
    wanted = docs.join(plan, same, "left").withColumn(times, copies).where(F.col(times) > 0)
    repeated = wanted.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
