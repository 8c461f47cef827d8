"""Each check passes on clean rows and is the one that fails on a single planted defect."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from sluiceway.functions.metrics import Check
from sluiceway.operators import modeltests as mt
from sluiceway.operators.keys import missing_references
from sluiceway.operators.profile import attach, duplicate_metric, fused_metrics
from sluiceway.operators.reconcile import consistency, table_totals
from sluiceway.operators.verdict import verdicts
from sluiceway.plans import transactions as tx
from sluiceway.sources.samples import sample_accounts, sample_instruments, sample_transactions

BY = ["_BATCH_ID"]
NULL = None

# batch name -> (column, value of the first row, checks that must fail)
GATE1 = {
    "clean": (None, None, set()),
    "no id": ("TXN_ID", NULL, {"NULL_TXN_ID", "MISSING_SCHEMA_KEYS", "DUP_TXN_ID_IN_BATCH"}),
    "no account": ("ACCOUNT_ID", NULL, {"NULL_ACCOUNT_ID", "MISSING_SCHEMA_KEYS"}),
    "no amount": ("AMOUNT", NULL, {"NULL_AMOUNT", "MISSING_SCHEMA_KEYS"}),
    "no date": ("TXN_DATE", NULL, {"NULL_TXN_DATE", "MISSING_SCHEMA_KEYS"}),
    "no instrument": ("INSTRUMENT_ID", NULL, {"MISSING_SCHEMA_KEYS"}),
    "letters": ("AMOUNT", "12x", {"BAD_FMT_AMOUNT", "BAD_CAST_AMOUNT"}),
    "right letters, no number": ("AMOUNT", "1-2", {"BAD_CAST_AMOUNT"}),
    "too wide": ("AMOUNT", "123456789012345678", {"BAD_CAST_AMOUNT"}),
    "prefix": ("TXN_ID", "0000000000", {"BAD_FMT_TXN_ID"}),
    "lower case": ("CURRENCY", "usd", {"BAD_FMT_CURRENCY", "BAD_DOMAIN_CURRENCY"}),
    "other code": ("CURRENCY", "XXX", {"BAD_DOMAIN_CURRENCY"}),
    "status": ("STATUS", "UNKNOWN", {"BAD_DOMAIN_STATUS"}),
    "date form": ("TXN_DATE", "2024-1-5", {"BAD_CAST_TXN_DATE"}),
    "date value": ("TXN_DATE", "2024-02-30", {"BAD_CAST_TXN_DATE"}),
    "settlement": ("SETTLEMENT_DATE", "n.d.", {"BAD_CAST_SETTLE_DATE"}),
    "twice": ("TXN_ID", "TXN-0000000001", {"DUP_TXN_ID_IN_BATCH"}),
}


def batches(spark, cases, n=12):
    """One batch per case, with the defect in its first row."""
    rows = sample_transactions(spark, n, "2024-03-01", accounts=5)
    names = spark.createDataFrame([(c,) for c in cases], "_BATCH_ID string")
    out = rows.join(names, F.lit(n) > 0)
    first = F.col("TXN_ID") == "TXN-0000000000"
    for column in tx.KEYS:
        new = F.col(column)
        for case, (target, value, _) in cases.items():
            if target == column:
                new = F.when((F.col("_BATCH_ID") == case) & F.col("first"), F.lit(value)).otherwise(new)
        out = out.withColumn("first", first) if "first" not in out.columns else out
        out = out.withColumn(column, new)
    return out.drop("first").withColumn("_LOADED_AT", F.lit("2024-03-01 10:00:00").cast("timestamp_ntz")).withColumn(
        "_FILENAME", F.lit("f")
    )


def failed_by_batch(judged):
    out = {}
    for r in judged.collect():
        out.setdefault(r["_BATCH_ID"], set())
        if not r["passed"]:
            out[r["_BATCH_ID"]].add(r["metric"])
    return out


def test_mirror_suite(spark):
    rows = batches(spark, GATE1)
    suite = tx.mirror_suite()
    metrics = attach(fused_metrics(rows, suite, BY), duplicate_metric(rows, "TXN_ID", "DUP_TXN_ID_IN_BATCH", BY), BY)
    judged = verdicts(metrics, suite, BY)
    assert failed_by_batch(judged) == {case: want for case, (_, _, want) in GATE1.items()}
    assert len(suite) == 15 and len(tx.mirror_suite(F.current_timestamp())) == 17


GATE2 = {
    "clean": (None, None, set()),
    "no id": ("TXN_ID", NULL, {"NULL_TXN_ID", "DUP_TXN_ID"}),
    "no account": ("ACCOUNT_ID", NULL, {"NULL_ACCOUNT_ID"}),
    "no amount": ("AMOUNT", NULL, {"NULL_AMOUNT"}),
    "no date": ("TXN_DATE", NULL, {"NULL_TXN_DATE"}),
    "currency": ("CURRENCY", "XXX", {"BAD_DOMAIN_CURRENCY"}),
    "no currency": ("CURRENCY", NULL, set()),
    "status": ("STATUS", "X", {"BAD_DOMAIN_STATUS"}),
    "zero": ("AMOUNT", "0", {"BAD_RANGE_AMOUNT"}),
    "too much": ("AMOUNT", "100000000.0001", {"BAD_RANGE_AMOUNT"}),
    "just right": ("AMOUNT", "100000000", set()),
    "twice": ("TXN_ID", "TXN-0000000001", {"DUP_TXN_ID"}),
}


def test_staging_suite(spark):
    rows = tx.typed_rows(batches(spark, GATE2))
    suite = tx.staging_suite()
    metrics = attach(fused_metrics(rows, suite, BY), duplicate_metric(rows, "TXN_ID", "DUP_TXN_ID", BY), BY)
    assert failed_by_batch(verdicts(metrics, suite, BY)) == {c: w for c, (_, _, w) in GATE2.items()}
    assert len(suite) == 13


def test_mart_suite(spark):
    cases = {c: v for c, v in GATE2.items() if v[0] not in ("TXN_ID",)}
    mart = tx.derive_mart(tx.typed_rows(batches(spark, cases)))
    mart = mart.withColumn(
        "TXN_MONTH", F.when(F.col("_BATCH_ID") == "no currency", F.date_sub("TXN_MONTH", 1)).otherwise(F.col("TXN_MONTH"))
    )
    want = {c: set(w) for c, (_, _, w) in cases.items()}
    want["no date"] |= {"NULL_TXN_MONTH", "NULL_TXN_YEAR"}
    want["no currency"] = {"BAD_DERIVED_TXN_MONTH"}
    assert failed_by_batch(verdicts(fused_metrics(mart, tx.mart_suite(), BY), tx.mart_suite(), BY)) == want
    assert len(tx.mart_suite()) + len(tx.consistency_suite()) == 17


@pytest.mark.parametrize(
    ("change", "want"),
    [
        (lambda d: d, set()),
        (lambda d: d.where("TXN_ID <> 'TXN-0000000000'"),
         {"amount_matches_stg", "row_count_within_1pct", "distinct_txn_id_matches_stg"}),
        (lambda d: d.withColumn("AMOUNT", (F.col("AMOUNT") + 1).cast("decimal(18,4)")), {"amount_matches_stg"}),
        (lambda d: d.withColumn("ACCOUNT_ID", F.lit("A")), {"all_accounts_in_sdm"}),
        (lambda d: d.withColumn("CURRENCY", F.lit("USD")), {"all_currencies_in_sdm"}),
        (lambda d: d.withColumn("_LOADED_AT", F.expr("_LOADED_AT - INTERVAL 31 MINUTES")), {"sdm_within_30min_of_stg"}),
        (lambda d: d.withColumn("_LOADED_AT", F.expr("_LOADED_AT - INTERVAL 30 MINUTES")), set()),
    ],
)
def test_consistency(spark, change, want):
    staging = tx.typed_rows(batches(spark, {"clean": GATE1["clean"]}, 60))
    dims = ("ACCOUNT_ID", "CURRENCY")
    sides = [
        table_totals(rows, side, "AMOUNT", "TXN_ID", dims, "_LOADED_AT")
        for rows, side in [(change(staging), "SDM"), (staging, "STG")]
    ]
    judged = verdicts(consistency(*sides), tx.consistency_suite()).collect()
    assert len(judged) == 6
    assert {r.metric for r in judged if not r.passed} == want


def test_references(spark):
    rows = sample_transactions(spark, 500, "2024-03-01")
    assert missing_references(rows, "ACCOUNT_ID", sample_accounts(spark), "ACCOUNT_ID").count() == 0
    assert missing_references(rows, "INSTRUMENT_ID", sample_instruments(spark), "INSTRUMENT_ID").count() == 0
    fewer = sample_accounts(spark).where("ACCOUNT_ID > 'ACCT-BR-100'")
    want = rows.where("ACCOUNT_ID <= 'ACCT-BR-100'").select("ACCOUNT_ID").distinct().count()
    with_null = rows.select("ACCOUNT_ID").unionAll(spark.range(2).select(F.lit(None).cast("string").alias("ACCOUNT_ID")))
    assert missing_references(with_null, "ACCOUNT_ID", fewer, "ACCOUNT_ID").count() == want + 1


def test_bounds_and_unknown_values(spark):
    metrics = spark.createDataFrame([(5, 0, None)], "a int, b int, c int")
    checks = [Check("a", "", None, 1, None), Check("b", "", None, None, -1), Check("c", "", None, None, 3)]
    assert {r.metric: r.passed for r in verdicts(metrics, checks).collect()} == {"a": True, "b": False, "c": False}


def test_table_tests(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (-2, "z")], "n int, s string")
    assert mt.not_null(rows, "n").count() == 1
    assert [tuple(r) for r in mt.unique(rows, "n").collect()] == [(1, 2)]
    assert [r.s for r in mt.accepted_values(rows, "s", ["a", "b"]).collect()] == ["z"]
    assert mt.positive(rows, "n").count() == 1
    assert mt.missing_columns(rows.withColumnRenamed("s", "_s"), ["n", "s"]) == ["s"]


@pytest.mark.parametrize(("hours", "state"), [(1, "pass"), (5, "warn"), (13, "error")])
def test_freshness(spark, hours, state):
    rows = spark.createDataFrame([("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz"))
    now = F.lit(f"2024-01-01 {hours:02}:00:00").cast("timestamp_ntz")
    assert mt.freshness(rows, "t", now, timedelta(hours=4), timedelta(hours=12)).first().state == state
