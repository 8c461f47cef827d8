"""Near vectors against brute force over all pairs."""

import math

import numpy as np
import pytest

from sluiceway.llm import vector_join

VECS = "vec_id long, embedding array<double>, label int"


def brute(rows, threshold=0.98):
    """Sorted (id, n_links, component) by comparing every two rows."""
    def usable(i, v, label):
        return i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = []
    for i, v, label in rows:
        if not usable(i, v, label):
            units.append(None)
            continue
        x = np.asarray(v, float) / max(abs(a) for a in v)
        units.append(x / np.linalg.norm(x))
    tree = list(range(len(rows)))

    def root(i):
        while tree[i] != i:
            i = tree[i]
        return i

    counts = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is None or b is None or len(a) != len(b) or rows[i][2] != rows[j][2] or a @ b < threshold:
                continue
            counts[i] += 1
            counts[j] += 1
            tree[root(i)] = root(j)
    least = {}
    for i, (key, *_) in enumerate(rows):
        if units[i] is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    return sorted(str((r[0], counts[i], least.get(root(i), r[0]))) for i, r in enumerate(rows))


def result(spark, rows, **options):
    table = spark.createDataFrame(rows, VECS).selectExpr("*", "'x' AS id", "1 AS block", "2 AS size", "3 AS component")
    found = vector_join.near_vectors(table, **options).collect()
    assert all(r["kept"] == (r["component_id"] in (None, r["vec_id"])) for r in found)
    return sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in found)


def clustered(rng, dims, groups, per_group, noise):
    for g in range(groups):
        centre = rng.standard_normal(dims)
        for _ in range(per_group):
            yield (centre + rng.standard_normal(dims) * noise * np.linalg.norm(centre) / math.sqrt(dims)).tolist()


@pytest.mark.parametrize("dims", [64, 20, 3, 1])
def test_matches_brute_force_around_the_threshold(spark, dims):
    rng = np.random.default_rng(dims)
    vectors = [v for noise in (0.02, 0.1, 0.14, 0.2) for v in clustered(rng, dims, 4, 8, noise)]
    vectors += [rng.standard_normal(dims).tolist() for _ in range(40)]
    vectors += [vectors[0], vectors[0], [3.5 * x for x in vectors[1]], [-x for x in vectors[2]], [1e-300 * x for x in vectors[3]], [1e300 * x for x in vectors[3]]]
    ids = rng.permutation(len(vectors) * 3)[: len(vectors)]
    rows = [(int(i), v, int(rng.integers(0, 2))) for i, v in zip(ids, vectors)]
    assert result(spark, rows) == brute(rows)


def test_large_cells_and_groups_are_cut_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    monkeypatch.setattr(vector_join, "TASK_ROWS", 16)
    vectors = list(clustered(rng, 16, 1, 70, 0.1)) + list(clustered(rng, 16, 3, 20, 0.13))
    rows = [(i, v, 1) for i, v in enumerate(vectors)]
    assert result(spark, rows) == brute(rows)


def test_unusable_vectors_repeated_rows_and_empty_table(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    rows = [(1, v, 1), (1, v, 1), (2, v, None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0, 0.0], 1), (6, [0.0, -0.0, 0.0], 1)]
    rows += [(7, [1.0, None, 3.0], 1), (8, [1.0, float("nan"), 3.0], 1), (9, [1.0, float("inf"), 3.0], 1), (10, [*v, 0.0], 1)]
    rows += [(11, v, 2), (12, [2.0, 4.0, 6.0], 1), (None, w, 1), (14, w, 1), (15, [3.0, -1.0, 0.5], 1), (16, [3.0, -0.0, 0.0], 3), (17, [3.0, 0.0, 0.0], 3)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_borderline_cosines_are_exact():
    a = np.array([1.0, 0.0])
    b = np.array([0.98, math.sqrt(1 - 0.98**2)])
    counts, links = vector_join.vector_links(np.stack([a, b]), np.array([1, 1]), np.arange(2), np.arange(2), 0.98)
    assert vector_join.exact_cosine(a, b) == pytest.approx(0.98, abs=1e-15)
    linked = int(vector_join.exact_cosine(a, b) >= 0.98)
    assert counts[0] >= linked


def test_no_pair_within_the_budget_is_missed():
    """Every pair at the threshold meets in a cell of some block, and its block comparison finds it."""
    rng = np.random.default_rng(9)
    turn = vector_join.rotation(64)
    for _ in range(60):
        x = rng.standard_normal(64)
        x /= np.linalg.norm(x)
        side = rng.standard_normal(64)
        side -= (side @ x) * x
        y = 0.98 * x + math.sqrt(1 - 0.98**2) * side / np.linalg.norm(side)
        codes = np.rint(np.stack([x, y]) @ turn * vector_join.SCALE).astype(np.int8)
        met = {}
        for block, rows, place in vector_join.cells(codes, 0.98):
            for row, cell in zip(rows, place):
                met.setdefault((block, tuple(cell)), set()).add(int(row))
        both = {block for (block, _), rows in met.items() if rows == {0, 1}}
        assert any(vector_join.block_matches(codes, np.arange(2), np.arange(2), b, 0.98) for b in both)
