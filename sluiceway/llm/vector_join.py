"""Near-duplicate vectors of one label by a subspace pigeonhole join.

Vectors of length one with a cosine of c or more are at most 2 - 2c apart in squared distance.  After a random rotation, which
spreads that distance evenly, the coordinates are split into blocks, and each block gets a part of
the budget in proportion to its dimensions: two vectors within the whole budget are within the budget of at least
one block, so the union of the blocks' range joins misses nothing.

Range join of a block: a grid over its first coordinates, with cells several radii wide, deals the vectors out; one
near a lower border also visits the cell below, so every two within the radius meet.  Rows carry the
rotated vector in one byte per coordinate.  A task walks its cell in the order of one more coordinate and
compares only what lies within the radius there.  All bounds are widened by what rounding can change.
Block matches whose rounded vectors are already too far apart are dropped; of the others a task
returns a spanning forest instead of all pairs.

Verification: trees of the union are groups; any link lies inside one.  Their vectors meet in full, and cosines are
computed in double precision; a task returns the number of links per vector and again a forest.  Cells and
groups too large for one task are dealt to pairs of bounded blocks.  Equal vectors are one row throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.graph import connected_components, store
from sluiceway.llm.skew import attach
from sluiceway.session import fits_broadcast

THRESHOLD = 0.98
BLOCK_DIMS = 8
GRID_DIMS = 2
CELL_RADII = 4.0  # width of a grid cell
TASK_ROWS = 8192  # members of a cell or group that one block of a task holds
SCALE = 127.0
SEED = 12
_CHUNK = 256
_CLOSE = 1e-9  # cosines this near to the threshold are recomputed without rounding errors


def budget(threshold: float) -> float:
    """Squared distance of two vectors of length one at the threshold, with room for rounding."""
    return 2.0 - 2.0 * threshold + 1e-9


@lru_cache(maxsize=4)
def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dims]).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def spans(dims: int) -> list[tuple[int, int]]:
    return [(at, min(at + BLOCK_DIMS, dims)) for at in range(0, dims, BLOCK_DIMS)]


def radius(threshold: float, block: int, dims: int) -> float:
    """Largest distance inside a block of `block` coordinates, in units of the codes."""
    return SCALE * math.sqrt(budget(threshold) * block / dims) + math.sqrt(block)


def unit(vector) -> np.ndarray | None:
    """The vector in double precision, at length one; None if it is missing, zero or not finite throughout."""
    if vector is None or len(vector) == 0 or any(v is None for v in vector):
        return None
    found = np.asarray(vector, np.float64)
    if not np.isfinite(found).all() or not found.any():
        return None
    found = found / np.abs(found).max()  # squares can neither overflow nor vanish
    return found / math.sqrt(found @ found)


def _usable(column: pa.Array) -> list:
    return [unit(v.values.to_numpy(zero_copy_only=False) if v.is_valid and not v.values.null_count else None) for v in column]


def _fingerprints(batch: pa.RecordBatch, found: list) -> list:
    """Digest of label and exact vector; adding zero makes both zeros one."""
    import xxhash

    labels, vectors = batch.column("label").to_pylist(), batch.column("vector")
    keys = []
    for label, vector, one in zip(labels, vectors, found):
        if one is None or label is None:
            keys.append(None)
            continue
        exact = np.asarray(vector.values.to_numpy(zero_copy_only=False), np.float64) + 0.0
        keys.append(xxhash.xxh3_128_digest(label.encode() + b"\0" + exact.tobytes()))
    return keys


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, label, dims, key and code of every row; key and code are null where a vector links with nothing."""
    for batch in batches:
        found = _usable(batch.column("vector"))
        keys = _fingerprints(batch, found)
        dims = [None if k is None else len(x) for k, x in zip(keys, found)]
        codes = [None] * len(keys)
        for size in {d for d in dims if d}:
            rows = [i for i, d in enumerate(dims) if d == size]
            turned = np.rint(np.stack([found[i] for i in rows]) @ rotation(size) * SCALE).astype(np.int8)
            for i, code in zip(rows, turned):
                codes[i] = code.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), pa.array(dims, pa.int32()), pa.array(keys, pa.binary()),
             pa.array(codes, pa.binary())],
            ["id", "label", "dims", "key", "code"],
        )


def cells(codes: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(block, rows, cells) of all places where the rows of a code matrix meet others; cells as (rows, GRID_DIMS) ints.

    Of two vectors within the radius, the one in the higher cell visits the one below, in every grid dimension by
    itself; so both are in the cell that is the lower one in each dimension.
    """
    dims = codes.shape[1]
    for block, (low, high) in enumerate(spans(dims)):
        reach = radius(threshold, high - low, dims)
        grid = codes[:, low : min(low + GRID_DIMS, high)].astype(np.float64)
        width = reach * CELL_RADII
        home = np.floor(grid / width).astype(np.int64)
        near = grid - home * width <= reach
        for step in range(1 << grid.shape[1]):
            down = np.array([step >> d & 1 for d in range(grid.shape[1])], bool)
            rows = np.flatnonzero(near[:, down].all(axis=1))
            place = np.zeros((len(rows), GRID_DIMS), np.int64)
            place[:, : grid.shape[1]] = home[rows] - down
            yield block, rows, place


def _dealt(threshold: float, with_code: bool):
    """Per class and cell: label, dims, block, cell, id and, if wanted, the code."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                dims = batch.column("dims").to_numpy(zero_copy_only=False)
                for size in np.unique(dims):
                    part = batch.filter(pa.array(dims == size))
                    codes = np.stack([np.frombuffer(c.as_py(), np.int8) for c in part.column("code")])
                    for block, rows, place in cells(codes, threshold):
                        if not len(rows):
                            continue
                        picked = part.take(pa.array(rows))
                        name = [",".join(map(str, p)) for p in place.tolist()]
                        out = [picked.column("label"), picked.column("dims"), pa.array(np.full(len(rows), block, np.int32)),
                               pa.array(name), picked.column("id")]
                        names = ["label", "dims", "block", "cell", "id"]
                        if with_code:
                            out.append(picked.column("code"))
                            names.append("code")
                        yield pa.RecordBatch.from_arrays(out, names)

    return deal


class Forest:
    """Trees over the rows of a task; remembers the links that joined two trees."""

    def __init__(self, size: int):
        self.tree, self.links = np.arange(size), []

    def join(self, row: int, others: np.ndarray) -> None:
        found, first = np.unique(self.tree[others], return_index=True)
        new = found != self.tree[row]
        if new.any():
            self.links += [(row, int(others[i])) for i in first[new]]
            self.tree[np.isin(self.tree, found[new])] = self.tree[row]


def _sides(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Rows of both sides of a block pair; a block against itself has one side."""
    side = rows["side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return (left, right) if len(right) else (left, left)


def block_matches(codes: np.ndarray, left, right, block: int, threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of both sides that match in the block and may be links."""
    dims = codes.shape[1]
    low, high = spans(dims)[block]
    reach = radius(threshold, high - low, dims)
    far = (SCALE * math.sqrt(budget(threshold)) + math.sqrt(dims)) ** 2
    # One more coordinate to walk along: the last of the block, which the grid does not use if it has others.
    one_side = left is right
    right = right[np.argsort(codes[right, high - 1], kind="stable")]
    along = codes[right, high - 1].astype(np.float64)
    left = right if one_side else left[np.argsort(codes[left, high - 1], kind="stable")]
    inner, full = codes[:, low:high].astype(np.float32), codes.astype(np.float32)
    forest = Forest(len(codes))
    for at in range(0, len(left), _CHUNK):
        rows = left[at : at + _CHUNK]
        edge = codes[rows, high - 1].astype(np.float64)
        # Within one side, earlier rows have met these already.
        first = at if one_side else np.searchsorted(along, edge[0] - reach, "left")
        window = right[first : np.searchsorted(along, edge[-1] + reach, "right")]
        # Whole numbers below 2^24: exact in single precision.
        apart = _distances(inner[rows], inner[window])
        for i, j in _by_row(apart <= reach * reach):
            others = window[j]
            others = others[(_distances(full[rows[i : i + 1]], full[others]) <= far)[0]]
            others = others[others != rows[i]]
            if len(others):
                forest.join(rows[i], others)
    return forest.links


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2.0 * (a @ b.T)


def _by_row(hits: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for i in np.flatnonzero(hits.any(axis=1)):
        yield i, np.flatnonzero(hits[i])


def _find_matches(threshold: float):
    def find(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        codes = np.stack([np.frombuffer(c, np.int8) for c in rows["code"]])
        ids = rows["id"].to_numpy()
        links = block_matches(codes, *_sides(rows), int(key[2]), threshold)
        return pd.DataFrame([(ids[a], ids[b]) for a, b in links], columns=["a", "b"], dtype="int64")

    return find


def exact_cosine(a: np.ndarray, b: np.ndarray) -> float:
    """Cosine from exactly rounded sums."""
    dot, left, right = (math.fsum(x * y) for x, y in ((a, b), (a, a), (b, b)))
    return dot / (math.sqrt(left) * math.sqrt(right))


def vector_links(vectors: np.ndarray, sizes: np.ndarray, left, right, threshold: float) -> tuple[np.ndarray, list]:
    """Per row how many vectors of the other side it is linked with, and a spanning forest of the links."""
    counts, forest, same = np.zeros(len(vectors), np.int64), Forest(len(vectors)), left is right
    for at in range(0, len(left), _CHUNK):
        rows = left[at : at + _CHUNK]
        others = right[at:] if same else right
        cosines = vectors[rows] @ vectors[others].T
        for i, j in zip(*np.nonzero(np.abs(cosines - threshold) < _CLOSE)):
            cosines[i, j] = exact_cosine(vectors[rows[i]], vectors[others[j]])
        linked = cosines >= threshold
        if same:  # each pair once
            linked &= np.arange(len(others))[None] > np.arange(len(rows))[:, None]
        counts[rows] += linked @ sizes[others]
        counts[others] += sizes[rows] @ linked
        for i, j in _by_row(linked):
            forest.join(rows[i], others[j])
    return counts, forest.links


def _count_links(threshold: float):
    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack([unit(v) for v in rows["vector"]])
        ids = rows["id"].to_numpy()
        counts, links = vector_links(vectors, rows["size"].to_numpy(np.int64), *_sides(rows), threshold)
        partners: dict[int, list[int]] = {}
        for a, b in links:
            partners.setdefault(a, []).append(int(ids[b]))
        return pd.DataFrame({
            "key": rows["key"], "id": ids, "links": counts, "partners": [partners.get(i, []) for i in range(len(ids))],
        })

    return count


def block_pairs(rows: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """`rows` with columns first, second, side: groups too large for one task become pairs of bounded blocks.

    `counts` holds `keys` and the size of every group.  Blocks hold about TASK_ROWS rows; each row goes to
    all pairs with its block, so a group of m rows makes m * (m / TASK_ROWS) rows and its comparisons stay in bounded tasks.
    """
    large = counts.where(F.col("count") > TASK_ROWS)
    large = store(large.select(*keys, F.ceil(F.col("count") / TASK_ROWS).cast("int").alias("blocks")), "large-groups")
    if fits_broadcast(large.count(), 128):
        large = F.broadcast(large)
    found = rows.join(large, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")

    def pair(other):
        return F.struct(
            F.least(other, F.col("own")).alias("first"), F.greatest(other, F.col("own")).alias("second"),
            (other < F.col("own")).cast("int").alias("side"),
        )

    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), pair)
    found = found.withColumn("own", own).withColumn("pair", F.explode(every))
    return found.select(*rows.columns, "pair.*")


def _verified(classes: DataFrame, groups: DataFrame, rows: DataFrame, threshold: float) -> DataFrame:
    """(key, id, links, partners) of the classes in `groups`, from their full vectors."""
    members = classes.drop("code").join(groups, F.col("id") == F.col("node"))
    members = store(members.select("key", "id", "size", "label", "dims", "component"), "members")

    def keyed(batches):
        for batch in batches:
            keys = _fingerprints(batch, _usable(batch.column("vector")))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *batch.columns], ["key", *batch.schema.names])

    kind = rows.schema["vector"].dataType.simpleString()
    exact = rows.mapInArrow(keyed, f"key binary, id bigint, label string, vector {kind}").select("key", "id", "vector")
    wanted = members.select("key", "id")
    wanted = F.broadcast(wanted) if fits_broadcast(wanted.count(), 32) else wanted
    # The row of the class's smallest id; repeated rows of that id are equal.
    exact = exact.join(wanted, ["key", "id"], "left_semi").dropDuplicates(["key"]).drop("id")
    keys = ["component", "label", "dims"]
    jobs = block_pairs(members.join(exact, "key"), members.groupBy(*keys).count(), keys)
    found = jobs.groupBy(*keys, "first", "second").applyInPandas(
        _count_links(threshold), "key binary, id bigint, links bigint, partners array<bigint>"
    )
    return store(found, "verified")


def near_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Vectors of equal, not null labels and equal length are linked when their cosine, in double precision, is at least
    `threshold`.  n_links counts the other rows linked directly, equal ones included; component_id is the smallest id
    reachable.

    Null, empty, zero vectors and those that hold null or non-finite numbers link with nothing, nor do rows without label or id; they
    stay alone and are kept.  Rows that repeat an id are told apart by their vectors, and count as others to each other if these
    are linked.  An empty table gives an empty result.  Other columns are not read.
    """
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector")
    )
    usable = rows.where("id IS NOT NULL")
    sketches = rows.mapInArrow(_sketches, "id bigint, label string, dims int, key binary, code binary")
    sketches = store(sketches, "sketches")
    classes = sketches.where("key IS NOT NULL AND id IS NOT NULL").groupBy("key").agg(
        F.min("id").alias("id"), F.count("*").alias("size"), F.max("id").alias("last"),
        *[F.first(c).alias(c) for c in ("label", "dims", "code")],
    )
    classes = store(classes, "classes")

    keys = ["label", "dims", "block", "cell"]
    where = "label string, dims int, block int, cell string, id bigint"
    source = classes.select("id", "label", "dims", "code")
    counts = source.mapInArrow(_dealt(threshold, False), where).groupBy(*keys).count()
    dealt = source.mapInArrow(_dealt(threshold, True), f"{where}, code binary")
    jobs = block_pairs(dealt, counts.where("count > 1"), keys).groupBy(*keys, "first", "second")
    candidates = store(jobs.applyInPandas(_find_matches(threshold), "a bigint, b bigint"), "candidates")

    groups = connected_components(candidates)
    verified = _verified(classes, groups, usable, threshold)
    links = verified.select(F.col("id").alias("a"), F.explode("partners").alias("b"))
    components = connected_components(links)
    per_class = verified.groupBy("key").agg(F.sum("links").alias("links"))
    facts = classes.drop("code").join(per_class, "key", "left").join(components, F.col("id") == F.col("node"), "left")
    facts = facts.select(
        "key", F.coalesce("component", "id").alias("component"), "size", "last", "id",
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"),
    )
    # Vectors that are alone need no look-up.
    facts = facts.where("links > 0 OR component <> id").select("key", "component", "size", "links")
    found = attach(sketches.select("id", "key"), store(facts, "facts"), "key", "size", 48)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return found.select(
        F.col("id").alias(id_col), F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), (component.isNull() | (component == F.col("id"))).alias("kept"),
    )


def oracle_query(table: str = "embeddings") -> str:
    """The result as DuckDB SQL over all pairs."""
    usable = "embedding IS NOT NULL AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0"
    return f"""WITH RECURSIVE
v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM {table} WHERE label IS NOT NULL AND {usable}
  AND len([y FOR y IN embedding IF y <> 0]) > 0),
e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= {THRESHOLD}),
r AS (SELECT a AS d, a AS r FROM e UNION SELECT e.b, r.r FROM r JOIN e ON e.a = r.d),
g AS (SELECT d, min(r) AS g FROM r GROUP BY d),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT t.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(g, t.vec_id)::BIGINT AS component_id,
  coalesce(g, t.vec_id) = t.vec_id AS kept FROM {table} t LEFT JOIN n ON n.a = t.vec_id LEFT JOIN g ON g.d = t.vec_id"""
