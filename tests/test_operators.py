"""Keys, running sums and upsert against brute force on small data with hot groups."""

from collections import Counter
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceway import session
from sluiceway.operators import keys as k
from sluiceway.operators.profile import fused_metrics
from sluiceway.operators.running import running_sum
from sluiceway.operators.upsert import upsert
from sluiceway.sources.tables import SchemaChanged


def skewed(spark, n=3000):
    """A third of all rows share one group; one group is NULL; some amounts are NULL."""
    i = F.col("id")
    group = F.when(i % 3 == 0, "hot").when(i % 50 == 1, None).otherwise(F.concat(F.lit("g"), (i % 17).cast("string")))
    return spark.range(n).select(
        group.alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(20))).alias("day"),
        F.concat(F.lit("K"), F.lpad(i.cast("string"), 6, "0")).alias("id"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) > 0, (i % 1000).cast("decimal(18,4)")).alias("amount"),
    )


@pytest.mark.parametrize(("large", "block"), [(10**6, None), (100, None), (500, 130), (1, 400)])
def test_running_sum(spark, large, block):
    rows = skewed(spark)
    got = running_sum(rows, "g", ["day", "id"], "amount", "s", large, block)
    assert dict(got.dtypes)["s"] == "decimal(28,4)"
    want, sums = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r.g or "", r.day, r.id)):
        if r.amount is not None:
            sums[r.g] = sums.get(r.g, Decimal(0)) + r.amount
        want[r.id] = sums.get(r.g)
    found = got.collect()
    assert len(found) == len(want)
    assert {r.id: r.s for r in found} == want


def test_large_group_is_spread(spark):
    got = running_sum(skewed(spark), "g", ["day", "id"], "amount", "s", large=300, block=100)
    assert "_block" in got._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("limit", [0, session.BROADCAST_LIMIT_BYTES])
def test_key_metrics(spark, monkeypatch, limit):
    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", limit)
    current = [None] + ["hot"] * 400 + [f"k{i}" for i in range(100)] + ["k1", "k2"]
    history = ["hot"] * 500 + [f"k{i}" for i in range(50, 300)] + [None, "a", "zzz"]
    frame = lambda xs: spark.createDataFrame([(x,) for x in xs], "key string")
    profile = fused_metrics(frame(current), k.KeyBounds.metrics("key")).first()
    bounds = k.KeyBounds.of(len(current), profile)
    found = k.key_metrics(frame(current), frame(history), "key", bounds, "d", "r").first()
    counts, old = Counter(x for x in current if x), {x for x in history if x}
    assert found.d == len(current) - len(counts)
    assert found.r == sum(n for x, n in counts.items() if x in old)


def test_key_metrics_first_batch(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "key string")
    bounds = k.KeyBounds.of(3, fused_metrics(rows, k.KeyBounds.metrics("key")).first())
    for history in (rows.limit(0), None):
        assert tuple(k.key_metrics(rows, history, "key", bounds, "d", "r").first()) == (1, 0)


def test_repeats_across(spark):
    data = [("hot", f"b{i % 4}") for i in range(400)] + [("x", "b1")] * 5 + [("y", "b1"), ("y", "b2"), (None, "b1")]
    got = {r.b: r.repeats for r in k.repeats_across(spark.createDataFrame(data, "key string, b string"), "key", "b").collect()}
    assert got == {"b0": 100, "b1": 101, "b2": 101, "b3": 100}


def test_latest_per_key(spark):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 100).alias("key"), F.col("id").alias("v")
    )
    got = {r.key: r.v for r in k.latest_per_key(rows, ["key"], [F.desc("v")]).collect()}
    want = {}
    for r in rows.collect():
        want[r.key] = max(want.get(r.key, -1), r.v)
    assert got == want


def test_provenance_and_latest_part(spark):
    a = spark.createDataFrame([("x", 1), ("y", 3), ("z", 3)], "b string, t int")
    assert [r.b for r in k.keys_without_origin(a, a.where("b <> 'y'"), "b").collect()] == ["y"]
    assert k.latest_part(a, "b", "t").first().b == "z"


rows_strategy = st.lists(st.tuples(st.integers(0, 8), st.integers(0, 99)), max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=rows_strategy, new=rows_strategy)
def test_upsert_replaces_and_is_idempotent(spark, old, new):
    target = spark.createDataFrame(list(dict(old).items()), "k int, v int")
    source = spark.createDataFrame(new, "k int, v int")
    once = upsert(target, source, ["k"], [F.desc("v")])
    want = dict(old)
    for key in {x for x, _ in new}:
        want[key] = max(v for x, v in new if x == key)
    assert {r.k: r.v for r in once.collect()} == want
    twice = upsert(once, source, ["k"], [F.desc("v")])
    assert sorted(map(tuple, twice.collect())) == sorted(want.items())


def test_upsert_refuses_other_schema(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(SchemaChanged, match="v2"):
        upsert(a, a.withColumnRenamed("v", "v2"), ["k"])
    with pytest.raises(SchemaChanged, match="retyped"):
        upsert(a, a.withColumn("v", F.col("v").cast("string")), ["k"])
