"""Exact duplicates, quality rules, mixing and packing on small hand-made tables."""

import hashlib
import itertools
import math

import duckdb
import numpy as np
import pytest

import oracle
from sluiceway.llm import digest_index, mixing, packing, pipeline_sql, quality, skew
from sluiceway.session import scratch_dir

ODD_TEXTS = [
    None, "", " ", "\n\n", "word", "a b c a b c", "the the the the the", "x\ny\nx\n \n \ny", "É é | # * <b>",
    "long " * 5000, " nbsp em", "tab\tsep\x0bvt\x1cfs", "A B\r\nA B\r\nA B",
]


def twin(df, sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows.toPandas())
    return oracle.compare([tuple(r) for r in df.collect()], df.columns, sql, con)


def odd_docs(make_docs, extra=()):
    return make_docs([(i, t, "en", "s" if i % 3 else None) for i, t in enumerate(ODD_TEXTS * 2)], extra)


def test_quality_of_odd_texts(make_docs):
    docs = odd_docs(make_docs, ("_x", "kept", "n_words"))
    assert twin(quality.quality_report(docs), quality.oracle_query("d"), d=docs.select("doc_id", "text")) is None
    assert quality.quality_report(make_docs([])).collect() == []


def test_quality_by_hand(make_docs):
    prose = " ".join(f"the w{i}" for i in range(40))
    rows = [(1, prose), (2, prose.replace("the", "|")), (3, "the w1 " * 40), (4, "few words"), (5, prose + " a b c x a b c")]
    found = {r["doc_id"]: r for r in quality.quality_report(make_docs(rows)).collect()}
    assert [found[i]["kept"] for i in (1, 2, 3, 4, 5)] == [True, False, False, False, True]
    assert found[3]["n_repeat_words"] == 80 and found[5]["n_repeat_words"] == 6
    assert [found[i]["base_failed"] for i in (2, 3, 4)] == [False, True, True]


def test_exact_duplicates(make_docs):
    docs = odd_docs(make_docs, ("digest", "keep_id", "_id"))
    index = digest_index.fresh_index(docs.sparkSession)
    found = index.add(docs).selectExpr("doc_id", "keep_id", "group_size", "kept", "lower(hex(digest)) text_sha256")
    assert twin(found, pipeline_sql.exact_sql("d"), d=docs.select("doc_id", "text")) is None
    one = found.where("doc_id = 5").first()
    assert one["text_sha256"] == hashlib.sha256(b"a b c a b c").hexdigest()


def test_later_deliveries_and_reopening(spark, make_docs):
    path = scratch_dir(spark, "index")
    first = digest_index.DigestIndex(spark, path, buckets=4)
    first.add(make_docs([(1, "A"), (2, "a"), (3, "b")]))
    again = digest_index.DigestIndex(spark, path, buckets=99)
    assert again.buckets == 4
    found = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in again.add(make_docs([(8, "a"), (9, "c"), (7, "c")])).collect()}
    assert found == {8: (2, False), 9: (9, True), 7: (9, False)}
    assert again.add(make_docs([])).collect() == []
    assert again.read().count() == 3


def test_a_delivery_that_broke_off_can_be_repeated(spark, make_docs, monkeypatch):
    """Killed after each append in turn: the repeated delivery keeps what an undisturbed one keeps."""
    docs = make_docs([(i, f"t{i % 7}") for i in range(40)] + [(None, "t1"), (None, "n")])
    want = None
    for die_after in (0, 1, 2, 3, 9):
        index = digest_index.fresh_index(spark)
        index.add(make_docs([(500, "T3")]), delivery="before")
        append, done = digest_index.DigestIndex._append, []

        def dying(self, rows):
            if len(done) == die_after:
                raise KeyboardInterrupt
            done.append(1)
            append(self, rows)

        with monkeypatch.context() as patch:
            patch.setattr(digest_index.DigestIndex, "_append", dying)
            try:
                index.add(docs, delivery="x")
            except KeyboardInterrupt:
                pass
        found = sorted(str(tuple(r)) for r in index.add(docs, delivery="x").drop("digest").collect())
        want = want or found
        assert found == want and index.read().count() == 8
        assert sum("True" in f for f in found) == 7  # six texts and the one without id; t3 was known
        kept = digest_index.drop_exact_duplicates(docs, index, delivery="x")
        assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, 33, 34, 35, 36, 37, 39]


@pytest.mark.parametrize("slices", [1, 2, 7])
def test_slices_do_not_change_what_stays(make_docs, slices):
    docs = odd_docs(make_docs)
    index = digest_index.fresh_index(docs.sparkSession)
    found = index.add(docs, slices=slices).selectExpr("doc_id", "keep_id", "group_size", "kept", "lower(hex(digest)) text_sha256")
    index.close()
    assert twin(found, pipeline_sql.exact_sql("d"), d=docs.select("doc_id", "text")) is None


def test_the_index_is_dealt_to_more_buckets(spark, make_docs, monkeypatch):
    path = scratch_dir(spark, "index")
    monkeypatch.setattr(digest_index, "TEXTS_PER_BUCKET", 1)
    monkeypatch.setattr(digest_index, "LEAST_BUCKETS", 2)
    index = digest_index.DigestIndex(spark, path)
    index.add(make_docs([(i, f"t{i}") for i in range(5)]))
    assert index.buckets == 5
    index.rebucket(11)
    assert sorted(r.keep_id for r in index.read().collect()) == list(range(5))
    index.close()
    again = digest_index.DigestIndex(spark, path)
    assert again.buckets == 11 and again.read().count() == 5
    assert [r["kept"] for r in again.add(make_docs([(9, "t1"), (8, "u")])).orderBy("doc_id").collect()] == [True, False]
    again.close()


def test_anti_join_reads_the_index_in_its_buckets(spark, make_docs):
    index = digest_index.fresh_index(spark)
    index.add(make_docs([(1, "a"), (2, "b")]))
    new = spark.createDataFrame([(bytearray(b"x"),)], "digest binary").join(index.read().hint("merge"), "digest", "left_anti")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1


def test_dropping_exact_duplicates(spark, make_docs):
    docs = make_docs([(1, "Same"), (2, "same"), (2, "other"), (None, "same"), (None, None), (4, "")])
    kept = digest_index.drop_exact_duplicates(docs, digest_index.fresh_index(spark))
    assert sorted((str(r["doc_id"]), r["text"]) for r in kept.collect()) == [("2", "other"), ("2", "same"), ("4", "")]


def test_attach_without_room_for_all_groups(spark, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda *a: False)
    monkeypatch.setattr(skew, "BROADCAST_LIMIT_BYTES", 10**9)
    rows = spark.range(30_000).selectExpr("if(id % 3 < 2, 0L, id) AS k", "id")
    groups = rows.groupBy("k").count().withColumnRenamed("count", "size")
    found = skew.attach(rows, groups.where("k % 2 = 0"), "k", "size", 16).selectExpr("count(*)", "sum(size)", "count(size)").first()
    assert tuple(found) == (30_000, 20_000 * 20_000 + 5_000, 25_000)


@pytest.mark.parametrize("odd", [False, True])
def test_mixing_matches_sql(make_docs, monkeypatch, odd):
    rows = [(i, "w " * (1 + i % 7), "en", "abcd"[min(3, int(math.log2(1 + i % 50)) // 2)]) for i in range(600)]
    docs = odd_docs(make_docs, ("tokens", "copies", "s")) if odd else make_docs(rows)
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 20)
    ctes, plan = pipeline_sql.mixing_sql("d")
    found = mixing.reading_order(mixing.mixing_plan(docs))
    assert twin(found, f"WITH {ctes} {pipeline_sql.order_sql(plan)}", d=docs.select("doc_id", "text", "source")) is None


def test_mixture_keeps_to_its_weights(make_docs):
    sizes = {"big": 900, "mid": 90, "small": 12}
    rows = [(i, "one two three", "en", s) for i, s in enumerate(x for s, n in sizes.items() for x in [s] * n)]
    plan = mixing.mixing_plan(make_docs(rows)).collect()
    read = {s: sum(r["copies"] for r in plan if r["source"] == s) for s in sizes}
    assert read["big"] == 900 and read["small"] == 24 and 90 < read["mid"] < 180
    assert min(r["copies"] for r in plan) == 1
    small = mixing.mixing_plan(make_docs(rows), budget=300, entropy=math.log(3) - 0.01).collect()
    tokens = {s: 3 * sum(r["copies"] for r in small if r["source"] == s) for s in sizes}
    total = sum(tokens.values())
    assert 280 < total <= 300
    assert abs(-sum(t / total * math.log(t / total) for t in tokens.values()) - (math.log(3) - 0.01)) < 0.02
    assert mixing.mixing_plan(make_docs([])).collect() == []


def test_mix_repeats_rows(make_docs):
    rows = [(i, "a b", "en", "big") for i in range(40)] + [(99, "a b", "fr", None), (98, None, "fr", "none")]
    counts = {}
    for r in mixing.mix(make_docs(rows, ("_q",))).collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == {i: 1 for i in range(40)} | {99: 2, 98: 1}


def padding(bounds, lengths, counts):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))


@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_bounds_are_optimal(buckets):
    rng = np.random.default_rng(buckets)
    for size in (1, 2, 4, 9):
        lengths = np.sort(rng.choice(60, size, replace=False))
        counts = rng.integers(1, 20, size)
        best = min(
            padding([*c, lengths[-1]], lengths, counts)
            for k in range(min(buckets, size))
            for c in itertools.combinations(lengths[:-1], k)
        )
        bounds = packing.best_bounds(lengths, counts, buckets)
        assert len(bounds) <= buckets and padding(bounds, lengths, counts) == best
    assert packing.best_bounds(np.array([]), np.array([])) == []


@pytest.mark.parametrize("odd", [False, True])
def test_packing_matches_sql(make_docs, monkeypatch, odd):
    monkeypatch.setattr(packing, "CHUNK_ROWS", 50)
    rows = [(i, "w " * (1 + (i * i) % 397)) for i in range(700)] + [(3, "w " * 40_001)]
    docs = odd_docs(make_docs, ("bucket_length", "key")) if odd else make_docs(rows)
    ctes, out = pipeline_sql.packing_sql("d")
    found = packing.pack(docs)
    assert twin(found, f"WITH {ctes} SELECT * FROM {out}", d=docs.select("doc_id", "text")) is None
    batches = {}
    for r in found.collect():
        assert r["n_tokens"] <= r["bucket_length"]
        batches.setdefault((r["bucket_length"], r["batch"]), []).append(r["slot"])
    for (length, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots)))
        assert len(slots) * length <= packing.BATCH_TOKENS or len(slots) == 1
