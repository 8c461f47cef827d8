"""Key filters: no key is missed, few absent ones hit, and only parts that may hold a key are read."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.operators.upsert import merge_into
from sluiceway.plans.gates import gate_mirror
from sluiceway.plans.store import Store
from sluiceway.session import scoped_conf
from sluiceway.sources.listing import pending_files
from sluiceway.sources.loading import load_parquet
from sluiceway.sources.samples import sample_accounts, sample_instruments, sample_transactions
from sluiceway.sources.tables import PartTable
from sluiceway.sources.unload import unload_parquet

SCHEMA = StructType([StructField(n, StringType()) for n in ("k", "v", "part")])


def keyed(spark, first, n, part):
    return spark.range(first, first + n).select(F.md5(F.col("id").cast("string")).alias("k"), F.lit("old").alias("v"), F.lit(part).alias("part"))


@pytest.fixture()
def table(spark, folder):
    made = PartTable(spark, f"{folder}/t", SCHEMA, "part", key=F.col("k"))
    for i, n in enumerate([1, 100, 5000, 40000]):
        made.replace(keyed(spark, i * 100_000, n, f"p{i}"))
    return made


@pytest.fixture()
def reads(monkeypatch):
    """The parts each restricted read of a table asked for."""
    seen, read = [], PartTable.read

    def watched(self, only=None):
        if only is not None:
            seen.append(sorted({part for part, _ in only}))
        return read(self, only)

    monkeypatch.setattr(PartTable, "read", watched)
    return seen


def parts(table, keys):
    return sorted(part for part, _ in table.may_hold(keys.select("k"), keys.count()))


def test_no_key_is_missed(spark, table):
    for first, n, want in [(0, 1, "p0"), (100_099, 1, "p1"), (204_999, 1, "p2")]:
        assert parts(table, keyed(spark, first, n, "")) == [want]
    assert "p3" in parts(table, keyed(spark, 300_000, 40_000, ""))
    # Each stored key alone: its bits are set in its block.
    for first in (100_000, 100_050, 204_321, 339_999):
        assert f"p{first // 100_000}" in parts(table, keyed(spark, first, 1, ""))


def test_absent_keys_rarely_hit(spark, table):
    """20,000 absent keys, each asked for alone in the join, in the filter of the largest part."""
    from sluiceway.sources import sketches

    rows = table.read().where("part = 'p3'").select("k", F.lit("g").alias("g"))
    sizes = spark.createDataFrame([("g", 40_000)], "g string, rows bigint")
    filters = sketches.key_filters(rows, F.col("k"), ["g"], sizes)
    assert filters.select(F.max("blocks")).first()[0] == 8192
    blocks = filters.first().blocks
    probe = keyed(spark, 900_000, 20_000, "").select(
        sketches._block(F.col("k"), F.lit(blocks)).alias("block"), *[b.alias(f"_{w}") for w, b in sketches._bits(F.col("k")).items()]
    )
    match = probe.join(filters, "block")
    for i in range(8):
        match = match.where(F.col(f"w{i}").bitwiseAND(F.col(f"_w{i}")) != 0)
    assert match.count() <= 4


def test_nulls_empty_keys_and_repeats(spark, folder):
    table = PartTable(spark, f"{folder}/t", SCHEMA, "part", key=F.col("k"))
    nothing = spark.createDataFrame([], "k string")
    assert table.may_hold(nothing, 0) == set()
    rows = [(None, "x", "a")] * 3 + [("", "x", "b")] * 500 + [("same", "x", "c")] * 2000
    table.replace(spark.createDataFrame(rows, SCHEMA))
    ask = lambda *k: sorted(p for p, _ in table.may_hold(spark.createDataFrame([(x,) for x in k], "k string"), len(k)))
    assert ask("") == ["b"] and ask("same", "", None) == ["b", "c"] and ask(None) == [] and table.may_hold(nothing, 0) == set()


def test_versions_without_a_filter_are_always_read(spark, folder, table):
    plain = PartTable(spark, f"{folder}/t", SCHEMA, "part")
    plain.replace(keyed(spark, 700_000, 10, "before"))
    assert parts(table, keyed(spark, 100_000, 1, "")) == ["before", "p1"]


def test_replaced_and_vacuumed_versions_leave_no_filter(spark, folder, table):
    table.replace(keyed(spark, 500_000, 20, "p3"))
    assert parts(table, keyed(spark, 300_000, 100, "")) == []
    assert parts(table, keyed(spark, 500_000, 1, "")) == ["p3"]
    table.vacuum()
    kept = {n for n in os.listdir(f"{folder}/t/filters") if "=" in n}
    assert kept == {n for n in os.listdir(f"{folder}/t/data") if "=" in n} and len(kept) == 4


def test_a_repeated_publish_keeps_the_filter(spark, folder, monkeypatch):
    """A publish that dies after the filters are stored is repeated."""
    table = PartTable(spark, f"{folder}/t", SCHEMA, "part", key=F.col("k"))
    version, real = table.write(keyed(spark, 0, 50, "a")), PartTable._add_filters

    def dies(self, *args):
        real(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(PartTable, "_add_filters", dies)
    with pytest.raises(RuntimeError):
        table.publish([version])
    assert table.may_hold(keyed(spark, 0, 5, "").select("k"), 5) == set()
    monkeypatch.setattr(PartTable, "_add_filters", real)
    table.publish([version])
    assert parts(table, keyed(spark, 0, 5, "")) == ["a"] and parts(table, keyed(spark, 60, 5, "")) == []


def test_merge_reads_only_parts_with_hits(spark, table, reads):
    new = keyed(spark, 100_000, 5, "p9").unionByName(keyed(spark, 800_000, 5, "p9")).withColumn("v", F.lit("new"))
    merged = merge_into(table, new, ["k"])
    assert reads == [["p1"]] and merged.rewritten == ["p1"]
    counts = {(r.part, r.v): r["count"] for r in table.read().groupBy("part", "v").count().collect()}
    assert counts == {("p0", "old"): 1, ("p1", "old"): 95, ("p2", "old"): 5000, ("p3", "old"): 40000, ("p9", "new"): 10}


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_gate_reads_only_batches_with_hits(spark, folder, monkeypatch, reads, limit):
    """Random ids; the batch repeats 30 keys of the second of four.  Both ways count the same."""
    from sluiceway import session

    monkeypatch.setattr(session, "BROADCAST_LIMIT_BYTES", limit)
    store, landing = Store(spark, f"{folder}/store", sample_accounts(spark), sample_instruments(spark)), f"{folder}/in"
    mixed = lambda first, n: sample_transactions(spark, n, "2026-11-30", first).withColumn("TXN_ID", F.concat(F.lit("TXN-"), F.md5("TXN_ID")))
    for i in range(4):
        unload_parquet(mixed(i * 1000, 200), f"{landing}/{i}")
        load_parquet(spark, store.mirror, pending_files(spark, landing, store.mirror, "*.parquet"), {"BATCH_ID": f"b{i}"}, base=landing)
    unload_parquet(mixed(1000, 30).unionByName(mixed(9000, 100)), f"{landing}/new")
    load_parquet(spark, store.mirror, pending_files(spark, landing, store.mirror, "*.parquet"), {"BATCH_ID": "new"}, base=landing)
    found = {}
    monkeypatch.setattr("sluiceway.plans.gates.judge", lambda values, suite: found.update(values) or [])
    gate_mirror(store, "new")
    assert found["cross_batch_dup_txn_ids"] == 30 and found["DUP_TXN_ID_IN_BATCH"] == 0
    assert reads == ([["b1"]] if limit else [])
    gate_mirror(store, "b0")
    assert found["cross_batch_dup_txn_ids"] == 0 and len(reads) == (1 if limit else 0)


def test_keys_of_one_part_are_placed_by_many_tasks(spark):
    """The number of blocks reaches the rows without a shuffle by part, and a large filter is gathered in runs."""
    from sluiceway.sources import sketches

    rows = spark.range(1000).select((F.col("id") % 2).cast("string").alias("g"), F.col("id").cast("string").alias("k"))
    sizes = rows.groupBy("g").agg(F.count("*").alias("rows"))
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        filters = sketches.key_filters(rows, F.col("k"), ["g"], sizes)
        plan = filters._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        gathered = sketches.together(filters, ["g"])
        assert gathered.columns == filters.columns and "_run" in gathered._jdf.queryExecution().executedPlan().toString()
        assert gathered.exceptAll(filters).isEmpty() and gathered.count() == filters.count()
