"""Typed staging, upsert, incremental slice, mart and refresh."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.keys import latest_per_key
from sluiceway.operators.upsert import merge_into, upsert
from sluiceway.plans import transactions as tx
from sluiceway.registry import base as b
from sluiceway.registry.base import Query
from sluiceway.session import scratch_dir
from sluiceway.sources.tables import PartTable

SPLIT = "1998-07-01 00:00:00"
ORDER = tx.newest_first
KEY = ["TXN_ID"]
# Small enough to send most accounts of the test data through the block-wise sum.
TINY_GROUP, TINY_BLOCK = 5, 2000


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return tx.typed_rows(b.txn_dirty(spark, sf))


def _staging(spark: SparkSession, sf: str) -> DataFrame:
    return b.plain(tx.accepted_rows(_typed(spark, sf)))


def _rejected(spark: SparkSession, sf: str) -> DataFrame:
    return b.plain(tx.rejected_rows(_typed(spark, sf)))


STAGED = f"{b.DIRTY}, {b.typed_sql('txn_dirty')}"
REJECTED_SQL = f"""WITH {STAGED} SELECT {b.STAGED_SQL}, concat_ws(',', CASE WHEN AMOUNT IS NULL THEN 'AMOUNT' END,
  CASE WHEN TXN_DATE IS NULL THEN 'TXN_DATE' END, CASE WHEN TXN_ID IS NULL THEN 'TXN_ID' END) AS missing
  FROM typed WHERE AMOUNT IS NULL OR TXN_DATE IS NULL OR TXN_ID IS NULL"""


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted rows, one per key."""
    rows = tx.accepted_rows(_typed(spark, sf))
    return latest_per_key(rows, KEY, ORDER(*b.LATEST_TIES))


CLEAN = f"{STAGED}, {b.latest_sql('typed_ok', 'clean')}"


def _before_and_after(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Rows loaded up to a date, and a later delivery that repeats every seventh of them with a new amount."""
    raw = tx.typed_rows(b.txn_raw(spark, sf), "k")
    old = raw.where(F.col("_LOADED_AT") < SPLIT)
    again = old.where(F.col("k") % 7 == 0).select(
        *[c for c in tx.KEYS if c not in ("AMOUNT", "ACCOUNT_ID")],
        (F.col("AMOUNT") * 2).cast("decimal(18,4)").alias("AMOUNT"),
        # Some replaced rows move to another account.
        F.when(F.col("k") % 14 == 0, F.lit("ACCT-MOVED")).otherwise(F.col("ACCOUNT_ID")).alias("ACCOUNT_ID"),
        F.lit("2002-01-01 00:00:00").cast("timestamp_ntz").alias("_LOADED_AT"),
        F.lit("again.csv").alias("_FILENAME"),
        F.lit("B2002").alias("_BATCH_ID"),
    )
    new = raw.where(F.col("_LOADED_AT") >= SPLIT).drop("k").unionByName(again)
    return old.drop("k"), new


BEFORE_AFTER = f"""{b.RAW}, full_src AS (SELECT * FROM txn_raw), {b.typed_sql('full_src')},
keyed AS (SELECT t.*, CAST(substr(t.TXN_ID, 5) AS BIGINT) AS k FROM typed t),
merged AS (
  SELECT TXN_ID,
    CASE WHEN hit AND k % 14 = 0 THEN 'ACCT-MOVED' ELSE ACCOUNT_ID END AS ACCOUNT_ID, INSTRUMENT_ID,
    CASE WHEN hit THEN CAST(AMOUNT * 2 AS DECIMAL(18,4)) ELSE AMOUNT END AS AMOUNT, CURRENCY, TXN_DATE, SETTLEMENT_DATE,
    STATUS, CASE WHEN hit THEN TIMESTAMP '2002-01-01 00:00:00' ELSE _LOADED_AT END AS _LOADED_AT,
    CASE WHEN hit THEN 'again.csv' ELSE _FILENAME END AS _FILENAME,
    CASE WHEN hit THEN 'B2002' ELSE _BATCH_ID END AS _BATCH_ID
  FROM (SELECT *, k % 7 = 0 AND _LOADED_AT < TIMESTAMP '{SPLIT}' AS hit FROM keyed) h)"""
MERGED_SQL = f"WITH {BEFORE_AFTER} SELECT {b.STAGED_SQL} FROM merged"


def _upsert(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _before_and_after(spark, sf)
    return b.plain(upsert(old, new, KEY, ORDER()))


def _stored(spark: SparkSession, rows: DataFrame) -> PartTable:
    table = PartTable(spark, scratch_dir(spark, "staging"), tx.STAGING_SCHEMA, part="_BATCH_ID")
    table.replace(rows, spread=True)
    return table


def _stored_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The same upsert into a stored table: only parts with a replaced row are rewritten."""
    old, new = _before_and_after(spark, sf)
    table = _stored(spark, old)
    merge_into(table, new, KEY, ORDER())
    return b.plain(table.read())


def _slice(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.txn_raw(spark, sf)
    staged = tx.typed_rows(raw.where(F.col("_LOADED_AT") < SPLIT))
    return b.plain(tx.typed_rows(tx.slice_newer(raw, staged)))


def _passed_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Only batches whose first gate passed are taken over: here those without a failed row."""
    raw = b.txn_raw(spark, sf)
    bad = raw.where(F.col("CURRENCY") == "CHF").where(F.col("STATUS") == "FAILED").where(F.col("AMOUNT").cast("double") > 450000)
    passed = raw.select("_FILENAME").distinct().join(bad.select("_FILENAME").distinct(), "_FILENAME", "left_anti")
    renamed = raw.withColumn("_BATCH_ID", F.col("_FILENAME"))
    return b.plain(tx.typed_rows(tx.slice_newer(renamed, tx.typed_rows(renamed).limit(0), passed)))


def _mart(spark: SparkSession, sf: str) -> DataFrame:
    return b.plain(tx.derive_mart(_clean(spark, sf)))


def _mart_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The mart with every larger account summed block by block."""
    return b.plain(tx.derive_mart(_clean(spark, sf), TINY_GROUP, TINY_BLOCK))


def _refresh(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _before_and_after(spark, sf)
    changed = latest_per_key(new, KEY, ORDER())
    gone = old.join(new.select(*KEY).distinct(), KEY, "left_semi").select("TXN_ID", "ACCOUNT_ID")
    return b.plain(tx.refresh_affected(tx.derive_mart(old), changed, gone))


QUERIES = {
    "typed_staging": Query(_staging, f"WITH {STAGED} SELECT {b.STAGED_SQL} FROM typed_ok"),
    "rejected_rows": Query(_rejected, REJECTED_SQL),
    "upsert_merge": Query(_upsert, MERGED_SQL),
    "stored_merge": Query(_stored_merge, MERGED_SQL),
    "incremental_slice": Query(
        _slice,
        f"WITH {b.RAW}, src AS (SELECT * FROM txn_raw WHERE _LOADED_AT >= TIMESTAMP '{SPLIT}'), {b.typed_sql('src')} "
        f"SELECT {b.STAGED_SQL} FROM typed",
    ),
    "passed_batches_slice": Query(
        _passed_slice,
        f"""WITH {b.RAW}, src AS (SELECT * REPLACE (_FILENAME AS _BATCH_ID) FROM txn_raw WHERE _FILENAME NOT IN (
          SELECT _FILENAME FROM txn_raw WHERE CURRENCY = 'CHF' AND STATUS = 'FAILED' AND CAST(AMOUNT AS DOUBLE) > 450000)),
        {b.typed_sql('src')} SELECT {b.STAGED_SQL} FROM typed""",
    ),
    "mart_derived": Query(_mart, f"WITH {CLEAN}, {b.mart_sql('clean')} SELECT {b.MART_SQL} FROM mart"),
    "mart_blockwise": Query(_mart_blocks, f"WITH {CLEAN}, {b.mart_sql('clean')} SELECT {b.MART_SQL} FROM mart"),
    "mart_refresh_affected": Query(
        _refresh, f"WITH {BEFORE_AFTER}, {b.mart_sql('merged')} SELECT {b.MART_SQL} FROM mart"
    ),
}
