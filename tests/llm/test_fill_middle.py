"""Fill-in-the-middle: against a plain reading, round trips, long and awkward texts."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import fill_middle

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text, rate=50):
    """(n, form, output, prefix_chars, middle_chars) by slices of a list."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", text, None, None
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    if h[3] % 100 < 80:
        return n, "spm", f"<S>{suf}<P>{pre}<M>{mid}", len(pre), len(mid)
    return n, "psm", f"<P>{pre}<S>{suf}<M>{mid}", len(pre), len(mid)


def texts():
    rng = random.Random(2)
    yield from ["", None, " ", "\n\n \t", "one", "  one", "one  ", "a\x0bb\x0cc\rd", "a\x1cb\x85c d e", "<", "<P", "x<P>y", "<M>", "$1\\2 $"]
    yield from ["< P > <S", "a<", "<\n<", "😀 é\n\n😀", "P><S>"]
    for _ in range(200):
        yield "".join(rng.choice([" ", "\n", "\t", "a", "b", "é", "😀", "<", ">", "P", "$", "\\"]) for _ in range(rng.randrange(60)))


@pytest.mark.parametrize("rate", [50, 100])
def test_equals_slices_of_the_units(make_docs, rate):
    rows = [(i, t) for i, t in enumerate(texts())] + [(3, "a b c"), (3, "a b c"), (None, "q r s"), (None, None), (-5, "x y")]
    found = fill_middle.with_middle(make_docs(rows, extra=("n", "form", "id", "h")), rate=rate)
    key = ("doc_id", "n", "form", "output", "prefix_chars", "middle_chars")
    want = [(i, *plainly(i, t, rate)) for i, t in rows]
    assert sorted(str(tuple(r[k] for k in key)) for r in found.collect()) == sorted(map(str, want))


def test_restores_every_text_and_empty_table(make_docs):
    rows = [(i, t) for i, t in enumerate(texts())]
    found = fill_middle.with_middle(make_docs(rows), rate=100).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    assert {r["doc_id"]: r["back"] for r in found.collect()} == {i: t or "" for i, t in rows}
    assert {r["form"] for r in found.collect()} == {"plain", "spm", "psm"}
    assert fill_middle.middle_digests(make_docs([])).collect() == []


def test_a_very_long_text_is_cut_whole(make_docs):
    text = "wörd  " * 400_000 + "end"
    rows = [(i, text) for i in range(6)]
    for r in fill_middle.with_middle(make_docs(rows), rate=100).collect():
        n, form, output, prefix, middle = plainly(r["doc_id"], text, 100)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output"] == output
