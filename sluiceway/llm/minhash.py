"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

Two families of short band keys ("halves") are computed per text; a table key is one half of
the first family with one of the second.  20 + 20 halves of 3 values give 400 tables of 6 values
from 120 minhashes, where plain banding would need 2,400.  Two texts of similarity 0.75 miss each other
in all tables with probability 4e-5.

The halves also cut the shuffle: a half that no other text shares cannot lead to a shared table
key, so only shared halves are combined.

Confirmation emits no pairs within a group.  Members of a bucket are compared with one member,
confirmed links are contracted, and only buckets that still hold several components go on: small ones
by their few pairs, large ones in blocks of bounded size that are compared inside a task and return links
only.  So every candidate pair of different components is decided on full sets, and nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.graph import connected_components, store
from sluiceway.llm.skew import attach
from sluiceway.llm.text import ROW, mix64, release_memory, shingle_set, small_batches, wrapped
from sluiceway.session import fits_broadcast

WIDTH = 5
THRESHOLD = 75  # per cent
HALVES = 20  # per family
VALUES = 3  # minhashes per half
SMALL_BUCKET = 8
BLOCK_SHINGLES = 200_000
SEED = 7

_SKETCH = "id long, n long, key binary, halves array<long>"


def _hash_family(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    factors = rng.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return factors, rng.integers(0, 2**63, count, dtype=np.uint64)


def half_keys(shingles: np.ndarray, halves: int = HALVES, values: int = VALUES) -> np.ndarray:
    """Keys of both families (2 * halves of them); each carries its own position."""
    factors, offsets = _hash_family(2 * halves * values)
    least = np.full(len(factors), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 4096):
        part = shingles[None, at : at + 4096] * factors[:, None] + offsets[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    least = least.reshape(2 * halves, values)
    key = np.arange(2 * halves, dtype=np.uint64)
    for i in range(values):
        key = mix64(key * np.uint64(31) + least[:, i])
    return key.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in batches:
        ids, counts, keys, halves = batch.column(0), [], [], []
        for text in batch.column(1):
            found = shingle_set(text.as_py(), WIDTH)
            counts.append(len(found))
            keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            halves.append(half_keys(found) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(halves, pa.list_(pa.int64()))],
            ["id", "n", "key", "halves"],
        )
    release_memory()


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):  # small pieces: sets of very long texts are large
            part = batch.slice(at, 64)
            sets = [shingle_set(t.as_py(), WIDTH).view(np.int64) for t in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"])
    release_memory()


def sizes_allow(a: Column, b: Column, threshold: int = THRESHOLD) -> Column:
    """Sets whose sizes differ more than this cannot reach the threshold."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * threshold


def _keep_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `df` whose id is in `ids`; the ids are sent to all tasks only if their count proves them small."""
    ids = F.broadcast(ids) if fits_broadcast(ids.count(), 16) else ids
    return df.join(ids, "id", "left_semi")


def candidate_tables(classes: DataFrame) -> DataFrame:
    """(bucket, node, n, size, centre, centre_n) of all table keys that at least two classes share."""
    rows = classes.select("node", "n", F.posexplode("halves").alias("place", "half"))
    shared = store(rows.groupBy("half").count().where("count > 1").select("half"), "halves")
    if fits_broadcast(shared.count(), 8):
        shared = F.broadcast(shared)
    rows = rows.join(shared, "half", "left_semi")
    first = F.collect_set(F.when(F.col("place") < HALVES, F.col("half")))
    second = F.collect_set(F.when(F.col("place") >= HALVES, F.col("half")))  # at most HALVES values each
    owned = rows.groupBy("node", "n").agg(first.alias("first"), second.alias("second"))
    pairs = owned.select("node", "n", F.explode("first").alias("f"), "second")
    keys = pairs.select("node", "n", "f", F.explode("second").alias("s"))
    tables = store(keys.select(F.xxhash64("f", "s").alias("bucket"), "node", "n"), "tables")
    least = F.min(F.struct("node", "n")).alias("least")
    full = tables.groupBy("bucket").agg(F.count("*").alias("size"), least)
    full = full.select("bucket", "size", F.col("least.node").alias("centre"), F.col("least.n").alias("centre_n"))
    return store(tables.join(full.where("size > 1"), "bucket"), "buckets")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Those of `pairs(a, b)` whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return both.where(common * 100 >= union * threshold).select("a", "b")


def _small_bucket_pairs(rows: DataFrame) -> DataFrame:
    """Pairs of different components of buckets with at most SMALL_BUCKET members.

    Buckets of the same members, usual across tables, are reduced to one before pairs are made.
    """
    member = F.struct("node", "n", "component")
    groups = rows.groupBy("bucket").agg(F.array_sort(F.collect_set(member)).alias("members"))
    groups = groups.select("members").distinct()
    one = groups.select(F.posexplode("members").alias("i", "x"), "members")
    two = one.select("x", F.explode(F.slice("members", F.col("i") + 2, F.lit(SMALL_BUCKET))).alias("y"))
    two = two.where((F.col("x.component") != F.col("y.component")) & sizes_allow(F.col("x.n"), F.col("y.n")))
    return two.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def _supported(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """Members that could still be linked to another component.

    A link needs 75 % of a member's own shingles in its partner, so a member with fewer
    shingles that any other component has at all is decided without a comparison.
    """
    both = docs.join(sets.withColumnRenamed("id", "node"), "node")
    owned = both.select("node", "component", F.size("shingles").alias("m"), F.explode("shingles").alias("shingle"))
    spread = owned.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    common = owned.join(spread.where("low <> high").select("shingle"), "shingle", "left_semi")
    able = common.groupBy("node", "m").count().where(F.col("count") * 100 >= F.col("m") * THRESHOLD)
    return docs.join(able.select("node").distinct(), "node", "left_semi")


def _jobs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(job, id, component, side) of block comparisons of the members of large buckets.

    Members of connected buckets form a cluster.  Within it, texts are ordered into size classes a
    factor 4/3 apart, so that only texts of one class or of neighbours can be similar, and classes are salted
    into blocks of about BLOCK_SHINGLES.  A job is a pair of blocks.
    """
    # The smallest member stands for a bucket: few different edges, however many tables repeat them.
    edges = rows.select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    clusters = connected_components(edges).toDF("node", "cluster")
    docs = _supported(store(rows.select("node", "n", "component").distinct(), "open-members"), sets)
    docs = docs.join(clusters, "node")
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4.0 / 3.0)) + 1e-9)
    docs = store(docs.withColumn("size_class", step), "members")
    blocks = docs.groupBy("cluster", "size_class").agg(
        F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("long").alias("blocks"), F.count("*").alias("members")
    )
    above = blocks.select("cluster", (F.col("size_class") - 1).alias("size_class"), F.col("blocks").alias("above"))
    below = blocks.select("cluster", (F.col("size_class") + 1).alias("size_class"), F.col("blocks").alias("below"))
    keys = ["cluster", "size_class"]
    all_blocks = blocks.join(above, keys, "left").join(below, keys, "left").na.fill(0, ["above", "below"])
    # One class of one cluster may hold most rows, and there are few classes: these go to the rows.
    place = F.concat_ws(":", *keys).alias("place")
    facts = store(all_blocks.select(place, "blocks", "above", "below", "members"), "blocks")
    docs = attach(docs.withColumn("place", place), facts, "place", "members", 64)
    docs = docs.withColumn("salt", F.pmod(F.xxhash64("node"), "blocks"))

    def job(low_class, low, high_class, high, side):
        return F.struct(F.xxhash64("cluster", low_class, low, high_class, high).alias("job"), F.lit(side).alias("side"))

    c, s = F.col("size_class"), F.col("salt")

    def up_to(count: str) -> Column:
        return F.when(F.col(count) > 0, F.sequence(F.lit(0).cast("long"), F.col(count) - 1)).otherwise(
            F.array().cast("array<long>")
        )

    own = F.transform(up_to("blocks"), lambda t: F.when(t >= s, job(c, s, c, t, 0)).otherwise(job(c, t, c, s, 1)))
    higher = F.transform(up_to("above"), lambda t: job(c, s, c + 1, t, 0))
    lower = F.transform(up_to("below"), lambda t: job(c - 1, t, c, s, 1))
    tasks = docs.select(F.col("node").alias("id"), "component", F.explode(F.concat(own, higher, lower)).alias("task"))
    return tasks.select("id", "component", "task.job", "task.side")


def block_links(ids, components, sides, sets, threshold: int = THRESHOLD) -> list[tuple]:
    """Links between the two sides of a block pair (or within one block), across components.

    Overlaps are counted through an inverted index of one side.  Of the links of one member
    to one component a single one is returned; it connects them just as well.
    """
    ids, components = np.asarray(ids), np.asarray(components)
    sizes = np.array([len(x) for x in sets])
    left = np.flatnonzero(np.asarray(sides) == 0)
    right = np.flatnonzero(np.asarray(sides) == 1)
    if not len(right):
        right = left
    if not len(left):
        left = right
    values = np.concatenate([sets[i] for i in right])
    owners = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    found = []
    for i in left:
        lo, hi = np.searchsorted(values, sets[i], "left"), np.searchsorted(values, sets[i], "right")
        spans = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(spans)[:-1])), spans) + np.arange(spans.sum())
        common = np.bincount(owners[at], minlength=len(right))
        good = common * 100 >= (sizes[i] + sizes[right] - common) * threshold
        good &= components[right] != components[i]
        seen = set()
        for j in right[np.flatnonzero(good)]:
            if components[j] not in seen:
                seen.add(components[j])
                found.append((int(ids[i]), int(ids[j])))
    return found


def _compare_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    links = block_links(rows["id"].values, rows["component"].values, rows["side"].values, rows["shingles"].tolist())
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _with_components(rows: DataFrame, components: DataFrame) -> DataFrame:
    found = rows.join(components.withColumnRenamed("component", "linked"), "node", "left")
    return found.withColumn("component", F.coalesce("linked", "node")).drop("linked")


def _links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes, enough to connect all that are similar."""
    buckets = candidate_tables(classes)
    needed = store(buckets.select(F.col("node").alias("id")).distinct(), "needed")
    sets = _keep_ids(docs, needed).mapInArrow(_full_sets, "id long, shingles array<long>")
    with small_batches(docs.sparkSession):
        sets = store(sets.distinct(), "sets")

    # A centre may have very many members; both joins below are shuffled anew, so that Spark can split them.
    star = buckets.where("node <> centre").where(sizes_allow(F.col("n"), F.col("centre_n")))
    star = star.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = store(confirmed(star, sets), "star")

    rows = _with_components(buckets, connected_components(links))
    spread = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    open_buckets = spread.where("low <> high").select("bucket")
    # A bucket of two was decided by its only pair.
    rows = store(rows.where("size > 2").join(open_buckets, "bucket", "left_semi"), "open")
    small = confirmed(_small_bucket_pairs(rows.where(F.col("size") <= SMALL_BUCKET)), sets)
    links = links.union(store(small, "small"))
    large = rows.where(F.col("size") > SMALL_BUCKET)
    if not large.isEmpty():
        work = _jobs(large, sets).join(sets, "id").groupBy("job").applyInPandas(_compare_blocks, "a long, b long")
        links = links.union(store(work, "large"))
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Texts are linked when at least 75 % of their joint 5-word shingles are common (words are runs of
    non-space characters, A-Z lower-cased); component_id is the smallest id reachable through links.

    Null, empty and blank texts have no shingles and stay alone.  Texts of one shingle set are one class
    and cost one comparison.  Rows that repeat an id are told apart by their texts: each
    gets the component of its own.  Very long texts are hashed in pieces.  A row with a null id stays alone, with a null component_id and kept true.  An empty table
    gives an empty result.  Other columns are not read.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    with small_batches(docs.sparkSession):
        sketches = store(docs.mapInArrow(_sketches, _SKETCH), "sketches")
    grouped = sketches.where("n > 0 AND id IS NOT NULL").groupBy("key")
    grouped = grouped.agg(F.min("id").alias("node"), F.first("n").alias("n"), F.first("halves").alias("halves"))
    classes = store(grouped, "classes")
    links = _links(docs.where("id IS NOT NULL"), classes)
    repeats = sketches.where("n > 0 AND id IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("node"), F.max("id").alias("most"), F.count("*").alias("size")
    )
    components = connected_components(links)
    # Only classes of several rows and linked classes need a look-up; the rest are their own component.
    labels = _with_components(repeats, components).where("component <> node OR node <> most")
    labels = store(labels.select("key", "component", "size"), "labels-by-key")
    by_id = components.select(F.col("node").alias("id"), F.col("component").alias("own"))
    # One text may be a third of all rows.
    found = attach(sketches.select("id", "n", "key"), labels, "key", "size", 48).join(by_id, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "own", "id"))
    return found.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        (component.isNull() | (component == F.col("id"))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows whose id is not the smallest of its component; columns unchanged, whatever their names.

    Null, empty and very long texts, null ids, repeated rows and an empty table are treated as in `near_duplicates`.
    """
    dropped = near_duplicates(docs, id_col, text_col).where("NOT kept").select(F.col(id_col).alias("id")).distinct()
    dropped = store(dropped, "dropped")
    if fits_broadcast(dropped.count(), 8):
        dropped = F.broadcast(dropped)
    return wrapped(docs, id=F.col(id_col)).join(dropped, "id", "left_anti").select(f"{ROW}.*")
