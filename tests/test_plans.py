"""Physical plans: one pruned scan, early reduction, no Python on the row path."""

from pyspark.sql import functions as F

from sluiceway.operators.keys import latest_per_key, missing_references
from sluiceway.operators.profile import fused_metrics, key_counts
from sluiceway.operators.reconcile import table_totals
from sluiceway.plans import transactions as tx
from sluiceway.registry import base as b
from sluiceway.sources.loading import load_parquet
from sluiceway.sources.mirror import open_mirror
from sluiceway.sources.listing import list_files
from sluiceway.sources.samples import sample_transactions
from sluiceway.sources.unload import unload_parquet

SF = "/root/testdata/sf0.001"


def plan(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def no_python(text):
    return "Python" not in text and "ArrowEval" not in text


def test_mirror_metrics_read_one_part_and_only_named_keys(spark, folder):
    unload_parquet(sample_transactions(spark, 200, "2024-03-01"), f"{folder}/in")
    files = [r.path for r in list_files(spark, f"{folder}/in", "*.parquet").collect()]
    mirror = open_mirror(spark, f"{folder}/mirror")
    for batch in ("one", "two"):
        load_parquet(spark, mirror, files, {"BATCH_ID": batch})
    rows = tx.mirror_keys(mirror.read()).where("_BATCH_ID = 'two'")
    text = plan(fused_metrics(rows, tx.mirror_suite()))
    assert text.count("FileScan") == 1 and "Expand" not in text and no_python(text)
    assert "PartitionFilters: [isnotnull(_BATCH_ID" in text
    two = plan(rows.agg(F.count("TXN_ID"), F.count("AMOUNT")))
    assert "ReadSchema: struct<RAW_DATA:struct<0:string,1:string>>" in two


def test_latest_row_is_chosen_before_the_shuffle(spark):
    text = plan(latest_per_key(b.txn_multi(spark, SF), ["TXN_ID"], [F.desc("_LOADED_AT")]))
    shuffle = text.index("Exchange hashpartitioning(TXN_ID")
    assert text.rindex("WindowGroupLimit") > shuffle > text.index("WindowGroupLimit")


def test_keys_are_counted_before_the_shuffle(spark):
    text = plan(key_counts(b.txn_multi(spark, SF), "TXN_ID"))
    assert text.count("HashAggregate") == 2 and "partial_count" in text and no_python(text)


def test_table_totals_do_not_copy_rows(spark):
    typed = tx.typed_rows(b.txn_raw(spark, SF))
    text = plan(table_totals(typed, "X", "AMOUNT", "TXN_ID", ("ACCOUNT_ID", "CURRENCY"), "_LOADED_AT"))
    # The copies for the distinct counts come after rows were reduced to combinations.
    assert text.index("Expand") < text.index("partial_sum(AMOUNT")


def test_reference_join_is_left_to_size(spark):
    text = plan(missing_references(b.table(spark, SF, "lineitem"), "l_partkey", b.table(spark, SF, "part"), "p_partkey"))
    assert "LeftAnti" in text and "ReadSchema: struct<l_partkey:bigint>" in text and "ReadSchema: struct<p_partkey:bigint>" in text


def test_high_water_mark_reaches_the_scan(spark, folder):
    tx.typed_rows(b.txn_raw(spark, SF)).write.parquet(f"{folder}/t")
    staged = spark.read.parquet(f"{folder}/t")
    text = plan(tx.slice_newer(staged, staged.where("_LOADED_AT < '1999-01-01'")))
    assert "GreaterThan(_LOADED_AT" in text


def test_mart_shuffles_once(spark, folder):
    tx.typed_rows(b.txn_raw(spark, SF)).write.parquet(f"{folder}/t")
    text = plan(tx.derive_mart(spark.read.parquet(f"{folder}/t")))
    assert text.count("Exchange") == 1 and no_python(text)
