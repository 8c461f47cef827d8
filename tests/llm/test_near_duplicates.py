"""Near duplicates against brute force over all pairs."""

import random
import re

import numpy as np

from sluiceway.llm import minhash
from sluiceway.llm.graph import connected_components
from sluiceway.llm.text import shingle_set


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingles(text):
    w = words_of(text)
    return {" ".join(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({" ".join(w)} if w else set())


def brute(rows):
    """Component of every row, by all pairs."""
    sets, label = [shingles(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                label[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), key), key)
    return [(key, len(sets[i]), least[root(i)]) for i, (key, _) in enumerate(rows)]


def noisy_group(rng, count, size, most):
    base = [f"w{rng.randrange(300)}" for _ in range(size)]
    for _ in range(count):
        copy = list(base)
        for _ in range(rng.randrange(most)):
            copy[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
        yield " ".join(copy)


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def test_shingles_as_stated():
    for text in ["a B c d E f", "one two", " \t\n", "", "Ä b c d e", "a  b\x0bc\x1cd e f g", "a a a a a a a"]:
        assert len(shingle_set(text)) == len(shingles(text)), repr(text)
    assert np.array_equal(shingle_set("A b c d e"), shingle_set("a B C\nd  e"))
    assert not np.array_equal(shingle_set("É b c d e"), shingle_set("é b c d e"))
    assert len(shingle_set("word " * 100_000 + "end")) == 2


def test_matches_brute_force_with_large_buckets(make_docs):
    rng = random.Random(3)
    texts = list(noisy_group(rng, 90, 60, 9))  # similarities all around the threshold
    texts += list(noisy_group(rng, 30, 200, 20)) + list(noisy_group(rng, 12, 30, 2))
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) for _ in range(30)]
    texts += texts[:5] + ["a b", "A  b", "a b c", "", " \n", None]
    ids = rng.sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    found = minhash.near_duplicates(make_docs(rows, extra=("id", "node", "component", "key", "n")))
    want = [(k, n, c if n else k) for k, n, c in brute(rows)]
    assert result(found) == sorted(want)
    assert {(r["doc_id"] == r["component_id"]) == r["kept"] for r in found.collect()} == {True}


def test_small_blocks_give_the_same_links(make_docs, monkeypatch):
    rng = random.Random(5)
    rows = list(enumerate(noisy_group(rng, 80, 50, 9)))
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 300)
    assert result(minhash.near_duplicates(make_docs(rows))) == sorted(brute(rows))


def test_null_ids_repeated_rows_and_empty_table(make_docs):
    text = "one two three four five six seven"
    rows = [(5, text), (5, text), (3, text.upper()), (None, text), (None, None), (9, "other words that stand alone here")]
    found = {(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(make_docs(rows)).collect()}
    assert found == {(5, 3, False), (3, 3, True), (None, None, True), (9, 9, True)}
    assert minhash.near_duplicates(make_docs([])).collect() == []
    assert minhash.drop_near_duplicates(make_docs([])).columns == make_docs([]).columns


def test_dropping_keeps_columns_and_one_of_each(make_docs):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (3, "q r s t u v"), (None, "a b c d e f")]
    kept = minhash.drop_near_duplicates(make_docs(rows, extra=("_dropped2",)))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "None"]
    assert "_dropped2" in kept.columns


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (0, 1)]
    found = dict(tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_tensored_tables_find_what_is_similar():
    """Of many pairs at the threshold, none is missed in all tables."""
    rng = np.random.default_rng(1)
    for _ in range(500):
        x = rng.integers(0, 2**63, 400, dtype=np.uint64)
        a, b = minhash.half_keys(x[:350]), minhash.half_keys(x[50:])  # 300 of 400 are common
        same = a == b
        assert same[: minhash.HALVES].any() and same[minhash.HALVES :].any()
