"""The filter audit against a plain count, over files in any order, with replayed and later epochs."""

import os
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import filter_audit

ORDERS = ["".join(p) for p in permutations("ABCDE")]


def plainly(rows, labels):
    """{(part, order, step): (kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)}"""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    failed = []
    for i, text, part in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i,
        }
        marks = [(q, x) for k, q, x in labels if k == i and k is not None]
        failed.append((part or "", {f for f in fails if fails[f]}, any(q == 1 for q, _ in marks), any(x == 1 for _, x in marks)))
    found = {}
    for part in {p for p, *_ in failed}:
        for order in ORDERS:
            gone = Counter()
            for step, f in enumerate(order):
                out = Counter()
                for p, bad, good, toxic in failed:
                    if p != part:
                        continue
                    before = bool(bad & set(order[:step]))
                    out["kept"] += not bad & set(order[: step + 1])
                    removed = f in bad and not before
                    out["removed"] += removed
                    out["redundant"] += f in bad and before
                    out["unique"] += bad == {f}
                    out["good"] += removed and good
                    out["toxic"] += removed and toxic
                gone[f] = out["removed"]
                found[part, order, step + 1] = [out[k] for k in ("kept", "removed", "redundant", "unique", "good", "toxic")]
    total = Counter()
    for (part, order, step), v in found.items():
        total[part, order[step - 1]] += v[1]
    return {k: tuple(v) + (total[k[0], k[1][k[2] - 1]],) for k, v in found.items()}


def result(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in df.collect()}


def fixture():
    rng = random.Random(4)
    base = [" ".join(f"w{rng.randrange(k)}" for _ in range(n)) for k, n in ((999, 70), (9, 70), (999, 9), (999, 60), (5, 200))]
    base += [base[0] + " #", base[1].upper(), base[2].upper() + " $", "", None, base[4] + " |", "ABC", "abc"]
    ids = rng.sample(range(-40, 400), 150)
    rows = [(i, rng.choice(base), rng.choice(["x", "y", None, ""])) for i in ids]
    rows += [(ids[0], rows[0][1], "x"), (ids[0], rows[0][1], "y"), (ids[1], "abc", "x"), (None, base[0], "x"), (None, None, "z")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in ids[::2]] + [(ids[0], 1, 0), (ids[0], 0, 1), (None, 1, 1), (9999, 1, 1)]
    return rows, labels


DOCS = "doc_id long, text string, source string"


def write(spark, rows, path, files):
    """`files` files, the first rows first: a stream takes older files before newer ones."""
    cut = -(-len(rows) // files)
    for at in range(0, len(rows), cut):
        part = spark.createDataFrame(rows[at : at + cut], DOCS).selectExpr("*", "'clash' AS part", "1 AS mask")
        part.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("falling", [True, False])
def test_equals_a_plain_count_in_any_order(spark, folder, falling):
    rows, labels = fixture()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0), reverse=falling)
    write(spark, order, f"{folder}/docs", 5)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.filter_audit(spark, f"{folder}/docs", marks, rounds=5)
    assert result(found) == plainly(rows, labels)


def test_later_files_and_replayed_epochs(spark, folder):
    rows, labels = fixture()
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0), reverse=True)
    write(spark, order[:90], f"{folder}/docs", 2)
    audit = filter_audit.run_audit(spark, f"{folder}/docs", marks, rounds=2, path=f"{folder}/audit")
    assert result(filter_audit.interactions(audit.counters())) == plainly(order[:90], labels)
    write(spark, order[90:], f"{folder}/docs", 1)
    audit = filter_audit.run_audit(spark, f"{folder}/docs", marks, rounds=1, path=f"{folder}/audit")
    assert result(filter_audit.interactions(audit.counters())) == plainly(order, labels)
    # An epoch that runs again, as after a lost driver, replaces what it had written.
    last = spark.createDataFrame(order[90:], "id long, text string, part string")
    text = F.coalesce("text", F.lit(""))
    judged = last.select(
        "id", F.coalesce("part", F.lit("")).alias("part"), filter_audit.mask(text).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest")
    )
    epoch = max(int(name) for name in os.listdir(f"{folder}/audit/state"))
    audit.take(judged, epoch, filter_audit._label_flags(marks, "doc_id"))
    assert result(filter_audit.interactions(audit.counters())) == plainly(order, labels)


def test_empty_table_and_single_file(spark, folder):
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{folder}/none")
    assert filter_audit.filter_audit(spark, f"{folder}/none", marks).collect() == []
    one = f"{folder}/one"
    spark.createDataFrame([(1, "x" * 100_000 + " y" * 60, "s")], "doc_id long, text string, source string").coalesce(1).write.parquet(one)
    name = next(n for n in os.listdir(one) if n.endswith(".parquet"))
    found = result(filter_audit.filter_audit(spark, f"{one}/{name}", marks))
    assert found == plainly([(1, "x" * 100_000 + " y" * 60, "s")], [])
