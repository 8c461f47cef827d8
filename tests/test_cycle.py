"""The whole cycle: success, re-run, failing batches, what is logged; and the same by stream."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from sluiceway.operators.audit import alert_message, utc_now
from sluiceway.operators.reconcile import KEY_SUMS, fact_totals, table_totals, with_key_counts
from sluiceway.operators.verdict import EmptyBatch, GateFailed
from sluiceway.plans import transactions as tx
from sluiceway.plans.cycle import newest_batch, rebuild_mart, refresh_mart, run_cycle, stage_new_rows
from sluiceway.plans.gates import gate_mart, gate_mirror, gate_staging
from sluiceway.plans.store import Store
from sluiceway.sources.loading import load_parquet
from sluiceway.sources.listing import pending_files
from sluiceway.sources.samples import sample_accounts, sample_instruments, sample_transactions
from sluiceway.sources.tables import PartTable
from sluiceway.sources.unload import unload_csv, unload_parquet
from sluiceway.streaming.pickup import pick_up

TODAY = "2026-11-30"


def make_store(spark, folder):
    return Store(spark, f"{folder}/store", sample_accounts(spark), sample_instruments(spark))


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_cycle(spark, folder):
    store, landing = make_store(spark, folder), f"{folder}/in"
    good = lambda first, n: sample_transactions(spark, n, TODAY, first)

    unload_parquet(good(0, 600), f"{landing}/one", 200)
    first = run_cycle(store, landing, context={"BATCH_ID": "one"})
    assert first.status == "SUCCESS" and [(g.layer, len(g.checks)) for g in first.gates] == [("ML", 17), ("STG", 13), ("SDM", 17)]
    assert run_cycle(store, landing).status == "EMPTY"

    # A batch that repeats keys of the first and breaks a rule: stopped at the first gate and kept out of staging.
    bad = good(500, 300).withColumn("CURRENCY", F.lit("usd"))
    unload_csv(bad, f"{landing}/two")
    second = run_cycle(store, landing, "csv", context={"BATCH_ID": "two"})
    assert second.status == "FAILED" and {f.split(":")[0] for f in second.failed} == {
        "BAD_FMT_CURRENCY", "BAD_DOMAIN_CURRENCY", "cross_batch_dup_txn_ids",
    }
    assert "FAILED: value=100.0" in str(second.failed)

    unload_csv(good(2000, 300), f"{landing}/three")
    third = run_cycle(store, landing, "csv", context={"BATCH_ID": "three"})
    assert third.status == "SUCCESS"
    staged = store.staging.read()
    assert {r[0]: r[1] for r in staged.groupBy("_BATCH_ID").count().collect()} == {"one": 600, "three": 300}
    assert newest_batch(store.mirror.read()) == "three"
    assert same_rows(store.mart_rows(), tx.derive_mart(staged))

    results = store.audit.table("TDQ_RESULTS")
    assert {(r.BATCH_ID, r.LAYER): r.PASSED for r in results.collect()} == {
        ("one", "ML"): True, ("one", "STG"): True, ("one", "SDM"): True, ("two", "ML"): False,
        ("three", "ML"): True, ("three", "STG"): True, ("three", "SDM"): True,
    }
    failed = results.where("not PASSED").select(F.to_json("FAILED_DETAILS").alias("d"), "FAILED_COUNT").first()
    assert failed.FAILED_COUNT == 3 and "BAD_FMT_CURRENCY" in failed.d
    message = alert_message(results, F.lit(str(utc_now())).cast("timestamp_ntz")).first().message
    assert message.startswith("Layer: ML | Table: mirror | Failed: 3/17 | Time: ") and message.endswith("| Batch: two")
    assert alert_message(results, F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")).isEmpty()

    runs = {r.BATCH_ID: r for r in store.audit.table("PIPELINE_RUNS").collect()}
    assert {b: r.STATUS for b, r in runs.items()} == {"one": "SUCCESS", "two": "FAILED", "three": "SUCCESS"}
    assert not runs["two"].ML_TDQ_PASSED and runs["three"].SDM_BDQ_PASSED
    phases = store.audit.table("STRESS_TEST_RESULTS").where("TEST_RUN_ID = 'three'").collect()
    assert {p.PHASE for p in phases} == {"INGEST", "ML_TDQ", "TRANSFORM", "STG_BDQ", "SDM_BDQ", "TOTAL_E2E"}
    assert all(p.ROWS_PROCESSED == 300 and p.FILES_PROCESSED >= 1 and p.START_TS <= p.END_TS for p in phases)
    assert store.audit.table("PERFORMANCE_BENCHMARKS").count() == 3

    # Gates 2 and 3 on damaged tables.
    with pytest.raises(EmptyBatch):
        gate_mirror(store, "nothing")
    with pytest.raises(EmptyBatch):
        gate_staging(store, "nothing")
    poor = Store(spark, store.root, store.accounts.limit(1), store.instruments.limit(1))
    with pytest.raises(GateFailed, match="BAD_REF_ACCOUNT.*BAD_REF_INSTRUMENT"):
        gate_staging(poor, "three")
    with pytest.raises(GateFailed, match="loaded_within_7_days"):
        gate_mirror(store, "three", utc_now() + timedelta(days=8))
    store.mirror.delete_where(F.col("_BATCH_ID") == "one")
    with pytest.raises(GateFailed, match="batch_ids_exist_in_mirror"):
        gate_staging(store, "three")
    store.mart.delete_where(F.col("TXN_ID") == "TXN-0000000007")
    with pytest.raises(GateFailed, match="distinct_txn_id_matches_stg"):
        gate_mart(store, "three")
    rebuild_mart(store)
    assert gate_mart(store, "three").success


def test_replaced_rows_move_between_accounts(spark, folder):
    """Rows that replace others, late and in another account: refreshed mart equals a full rebuild."""
    store, landing = make_store(spark, folder), f"{folder}/in"
    unload_parquet(sample_transactions(spark, 400, TODAY, 0, accounts=7), f"{landing}/one")
    assert run_cycle(store, landing, context={"BATCH_ID": "one"}).status == "SUCCESS"
    later = store.staging.read().where("TXN_ID < 'TXN-0000000040'").select(
        "TXN_ID", F.lit("ACCT-BR-499").alias("ACCOUNT_ID"), "INSTRUMENT_ID", F.col("AMOUNT").cast("string").alias("AMOUNT"),
        "CURRENCY", F.lit("2020-01-01").alias("TXN_DATE"), F.lit("2020-01-02").alias("SETTLEMENT_DATE"), "STATUS",
    )
    unload_parquet(later, f"{landing}/two")
    files = pending_files(spark, landing, store.mirror, "*.parquet")
    load_parquet(spark, store.mirror, files, {"BATCH_ID": "two"}, base=landing)
    store.approve("two")
    merged = stage_new_rows(store)
    assert merged.rewritten == ["one"] and merged.replaced.count() == 40
    assert refresh_mart(store) and not refresh_mart(store)
    assert store.staging.read().count() == 400
    assert same_rows(store.mart_rows(), tx.derive_mart(store.staging.read()))
    assert stage_new_rows(store) is None


def test_stream_pickup_is_incremental(spark, folder):
    store, landing = make_store(spark, folder), f"{folder}/in"
    go = lambda: pick_up(spark, landing, store.mirror, f"{folder}/progress", "csv", files_per_batch=2).awaitTermination()
    unload_csv(sample_transactions(spark, 90, TODAY).repartition(3), f"{landing}/a")
    go()
    counts = lambda: {r[0]: r[1] for r in store.mirror.read().groupBy("_BATCH_ID").count().collect()}
    before = counts()
    assert sum(before.values()) == 90
    assert [k.split("-")[0] + k[-2:] for k in sorted(before)] == ["stream-0", "stream-1"]
    go()
    assert counts() == before
    unload_csv(sample_transactions(spark, 10, TODAY, 100), f"{landing}/b", single_file=True)
    go()
    after = counts()
    assert sum(after.values()) == 100 and {k: after[k] for k in before} == before
    assert gate_mirror(store, max(after)).success

    # A stream with a new checkpoint loads what is new to the mirror, beside the first one's batches.
    unload_csv(sample_transactions(spark, 7, TODAY, 200), f"{landing}/c", single_file=True)
    pick_up(spark, landing, store.mirror, f"{folder}/other", "csv").awaitTermination()
    assert sum(counts().values()) == 107 and {k: counts()[k] for k in after} == after


def load(spark, store, landing, name, rows):
    unload_parquet(rows, f"{landing}/{name}")
    files = pending_files(spark, landing, store.mirror, "*.parquet")
    return load_parquet(spark, store.mirror, files, {"BATCH_ID": name}, base=landing)


def test_mart_is_complete_after_a_gate_stop_and_a_crash(spark, folder, monkeypatch):
    store, landing = make_store(spark, folder), f"{folder}/in"
    unload_parquet(sample_transactions(spark, 60, TODAY, 0, accounts=7), f"{landing}/one")
    assert run_cycle(store, landing, context={"BATCH_ID": "one"}).status == "SUCCESS"
    wrong = sample_transactions(spark, 30, TODAY, 100, accounts=7).withColumn("INSTRUMENT_ID", F.lit("unknown"))
    unload_parquet(wrong, f"{landing}/two")
    assert run_cycle(store, landing, context={"BATCH_ID": "two"}).status == "FAILED"
    unload_parquet(sample_transactions(spark, 20, TODAY, 200, accounts=7), f"{landing}/three")
    assert run_cycle(store, landing, context={"BATCH_ID": "three"}).status == "SUCCESS"
    assert store.staging.read().count() == 110
    assert same_rows(store.mart_rows(), tx.derive_mart(store.staging.read()))

    # Killed between merge and refresh; the next run makes up for it.
    def killed(*_):
        raise KeyboardInterrupt

    unload_parquet(sample_transactions(spark, 15, TODAY, 300, accounts=7), f"{landing}/four")
    with monkeypatch.context() as patch:
        patch.setattr("sluiceway.plans.cycle.gate_staging", killed)
        with pytest.raises(KeyboardInterrupt):
            run_cycle(store, landing, context={"BATCH_ID": "four"})
    # Killed between the note and the merge: nothing shows, and the batch is staged later.
    load(spark, store, landing, "five", sample_transactions(spark, 9, TODAY, 400, accounts=7))
    store.approve("five")
    with monkeypatch.context() as patch:
        patch.setattr("sluiceway.sources.tables.PartTable.publish", killed)
        with pytest.raises(KeyboardInterrupt):
            stage_new_rows(store)
    assert store.staging.read().count() == 125 and store.mart_rows().count() == 110
    assert refresh_mart(store) and store.mart_rows().count() == 125
    assert stage_new_rows(store).arriving == ["five"]
    assert refresh_mart(store)
    assert same_rows(store.mart_rows(), tx.derive_mart(store.staging.read()))


def rows_of(spark, n, first, day, accounts=7, null_account=False):
    rows = sample_transactions(spark, n, TODAY, first, accounts=accounts)
    rows = rows.withColumn("TXN_DATE", F.date_add(F.lit(day), (F.substring("TXN_ID", 5, 10).cast("int") % 25)).cast("string"))
    if null_account:
        rows = rows.withColumn("ACCOUNT_ID", F.when(F.col("TXN_ID").endswith("3"), F.lit(None)).otherwise(F.col("ACCOUNT_ID")))
    return rows


def test_a_refresh_rewrites_the_changed_months_only(spark, folder):
    """Late rows, replaced rows that change month, an account that is missing: positions stay those of a full derivation."""
    store, landing = make_store(spark, folder), f"{folder}/in"

    def stage(name, rows):
        load(spark, store, landing, name, rows)
        store.approve(name)
        stage_new_rows(store)

    # Most of the rows lie in months that nothing changes later.
    stage("one", rows_of(spark, 900, 5000, "2026-01-01", null_account=True).unionByName(rows_of(spark, 200, 200, "2026-02-02")).unionByName(
        rows_of(spark, 200, 400, "2026-03-03", null_account=True)).unionByName(rows_of(spark, 200, 600, "2026-04-04")))
    assert refresh_mart(store)
    before = store.mart.live_parts()
    assert len(before) == 4
    stage("two", rows_of(spark, 30, 1000, "2026-02-01", accounts=9, null_account=True))
    # A row of April is delivered again, with a date in March.
    stage("three", rows_of(spark, 1, 610, "2026-03-01").withColumn("AMOUNT", F.lit("7.5")))
    assert refresh_mart(store) and not refresh_mart(store)
    after = store.mart.live_parts()
    assert {m for m in after if after[m] != before[m]} == {"2026-02-01", "2026-03-01", "2026-04-01"}
    assert same_rows(store.mart_rows(), tx.derive_mart(store.staging.read()))
    assert os.listdir(f"{folder}/store/changes") == [] and os.listdir(f"{folder}/store/staging/merges") == []
    stage("four", rows_of(spark, 3, 2000, "2026-04-20"))
    assert refresh_mart(store)
    assert store.mart.live_parts()["2026-02-01"] == after["2026-02-01"]
    assert same_rows(store.mart_rows(), tx.derive_mart(store.staging.read()))
    store.vacuum()
    assert same_rows(store.mart_rows(), tx.derive_mart(store.staging.read()))


def test_facts_add_up_to_what_the_tables_hold(spark, folder, monkeypatch):
    """After merges, deletions and snapshots; and the third gate finds a lost row and a changed key by them."""
    monkeypatch.setattr("sluiceway.sources.tables.SNAPSHOT_EVERY", 3)
    store, landing = make_store(spark, folder), f"{folder}/in"
    for i, name in enumerate(["one", "two", "three", "four"]):
        load(spark, store, landing, name, rows_of(spark, 60, 40 * i, "2026-02-01"))
        store.approve(name)
        stage_new_rows(store)
        refresh_mart(store)
    store.staging.delete_where(F.col("TXN_ID") == "TXN-0000000007")
    for table in (store.staging, store.mart):
        got = fact_totals({"T": table.read_facts()}, ("ACCOUNT_ID", "CURRENCY"))["T"].asDict()
        want = table_totals(table.read(), "T", "AMOUNT", "TXN_ID", ("ACCOUNT_ID", "CURRENCY"), "_LOADED_AT").first().asDict()
        assert {n: v for n, v in got.items() if "keys" not in n} == {n: v for n, v in want.items() if n != "T_DISTINCT_TXN_ID"}
    with pytest.raises(GateFailed, match="distinct_txn_id_matches_stg: FAILED: value=1.0"):
        gate_mart(store, "four")
    rebuild_mart(store)
    assert gate_mart(store, "four").success
    # Equal counts and amounts, but another key.
    one = store.mart.read().where("TXN_ID = 'TXN-0000000009'")
    other = store.mart.read().withColumn("TXN_ID", F.when(F.col("TXN_ID") == "TXN-0000000009", "TXN-0000000008").otherwise(F.col("TXN_ID")))
    store.mart.replace(other.where(F.col("_MONTH") == one.first()["_MONTH"]))
    with pytest.raises(GateFailed, match="distinct_txn_id_matches_stg: FAILED: value=1.0"):
        gate_mart(store, "four")


def test_third_gate_sums_facts_without_shuffling_them(spark, folder, monkeypatch):
    """Key hashes are added up as whole numbers; facts that lack them prove nothing, and the keys are counted."""
    store, landing = make_store(spark, folder), f"{folder}/in"
    load(spark, store, landing, "one", rows_of(spark, 60, 0, "2026-02-01"))
    store.approve("one")
    stage_new_rows(store)
    refresh_mart(store)
    facts = store.staging.read_facts()
    assert {facts.schema[n].dataType.simpleString() for n in KEY_SUMS} == {"bigint"}
    dims, taken = ("ACCOUNT_ID", "CURRENCY"), []
    collect = type(facts).collect
    monkeypatch.setattr(type(facts), "collect", lambda rows: taken.append(rows) or collect(rows))
    assert fact_totals({"T": facts}, dims)["T"]["keys"] is not None
    plan = taken[0]._jdf.queryExecution().sparkPlan().toString()
    assert not any("keys=[side" in line and all(d in line for d in dims) for line in plan.splitlines())
    old = facts.withColumns({n: F.lit(None).cast("bigint") for n in KEY_SUMS})
    assert fact_totals({"T": facts.unionByName(old)}, dims)["T"]["keys"] is None
    counted = with_key_counts(*[fact_totals({p: old}, dims)[p] for p in ("SDM", "STG")], "TXN_ID", store.mart.read(), store.staging.read().limit(0))
    assert counted.select("SDM_DISTINCT_TXN_ID", "STG_DISTINCT_TXN_ID").first() == (60, 0)


def test_refresh_of_new_months_compares_no_keys(spark, folder, monkeypatch):
    """Rows of months the mart does not have are derived without reading the mart; those of known months are still joined."""
    store, landing, read = make_store(spark, folder), f"{folder}/in", []
    stored = PartTable.read
    monkeypatch.setattr(PartTable, "read", lambda table, only=None: read.append(table.path) or stored(table, only))
    for name, first, day, joined in (("one", 0, "2026-02-01", False), ("two", 1000, "2026-05-01", False), ("three", 2000, "2026-05-02", True)):
        load(spark, store, landing, name, rows_of(spark, 60 if name == "one" else 10, first, day))
        store.approve(name)
        stage_new_rows(store)
        read.clear()
        assert refresh_mart(store)
        assert (store.mart.path in read) == joined
        assert same_rows(store.mart_rows(), tx.derive_mart(store.staging.read()))


def test_batches_that_pass_late_are_staged(spark, folder):
    store, landing = make_store(spark, folder), f"{folder}/in"
    load(spark, store, landing, "one", sample_transactions(spark, 30, TODAY, 0))
    load(spark, store, landing, "two", sample_transactions(spark, 40, TODAY, 20).withColumn("STATUS", F.lit("PENDING")))
    store.approve("two")
    assert stage_new_rows(store).arriving == ["two"]
    store.approve("one")
    stage_new_rows(store)
    # Of the ten common keys the newer batch's rows stay.
    assert {r[0]: r[1] for r in store.staging.read().groupBy("_BATCH_ID").count().collect()} == {"one": 20, "two": 40}
    assert stage_new_rows(store) is None
