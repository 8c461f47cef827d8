"""Gate metrics, verdicts, freshness and table tests."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators import modeltests as mt
from sluiceway.operators.keys import missing_references
from sluiceway.operators.profile import attach, batch_profile, duplicate_metric, fused_metrics
from sluiceway.operators.reconcile import consistency, lag_minutes, table_totals
from sluiceway.operators.verdict import verdicts
from sluiceway.plans import transactions as tx
from sluiceway.registry import base as b
from sluiceway.registry.base import Query

BATCH = ["_BATCH_ID"]


def _gate1(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.txn_dirty(spark, sf)
    metrics = fused_metrics(rows, tx.mirror_suite(), BATCH)
    return attach(metrics, duplicate_metric(rows, "TXN_ID", "DUP_TXN_ID_IN_BATCH", BATCH), BATCH)


GATE1_SQL = """gate1 AS (SELECT _BATCH_ID,
  count(*) FILTER (TXN_ID IS NULL) AS NULL_TXN_ID,
  count(*) FILTER (ACCOUNT_ID IS NULL) AS NULL_ACCOUNT_ID,
  count(*) FILTER (AMOUNT IS NULL) AS NULL_AMOUNT,
  count(*) FILTER (TXN_DATE IS NULL) AS NULL_TXN_DATE,
  count(*) FILTER (length(translate(AMOUNT, '0123456789.-', '')) > 0) AS BAD_FMT_AMOUNT,
  count(TXN_ID) - count(*) FILTER (TXN_ID LIKE 'TXN-%') AS BAD_FMT_TXN_ID,
  count(CURRENCY) - count(*) FILTER (length(CURRENCY) = 3 AND upper(CURRENCY) = CURRENCY) AS BAD_FMT_CURRENCY,
  count(*) FILTER (AMOUNT IS NOT NULL AND TRY_CAST(AMOUNT AS DECIMAL(18,4)) IS NULL) AS BAD_CAST_AMOUNT,
  count(*) FILTER (TXN_DATE IS NOT NULL AND (length(TXN_DATE) <> 10 OR try_strptime(TXN_DATE, '%Y-%m-%d') IS NULL))
    AS BAD_CAST_TXN_DATE,
  count(*) FILTER (SETTLEMENT_DATE IS NOT NULL AND (length(SETTLEMENT_DATE) <> 10
    OR try_strptime(SETTLEMENT_DATE, '%Y-%m-%d') IS NULL)) AS BAD_CAST_SETTLE_DATE,
  count(CURRENCY) - count(*) FILTER (CURRENCY IN ('USD','EUR','GBP','JPY','CHF')) AS BAD_DOMAIN_CURRENCY,
  count(STATUS) - count(*) FILTER (STATUS IN ('PENDING','SETTLED','CANCELLED','FAILED')) AS BAD_DOMAIN_STATUS,
  count(*) FILTER (TXN_ID IS NULL OR ACCOUNT_ID IS NULL OR INSTRUMENT_ID IS NULL OR AMOUNT IS NULL OR CURRENCY IS NULL
    OR TXN_DATE IS NULL OR SETTLEMENT_DATE IS NULL OR STATUS IS NULL) AS MISSING_SCHEMA_KEYS,
  count(*) AS TOTAL_ROWS,
  count(*) - count(DISTINCT TXN_ID) AS DUP_TXN_ID_IN_BATCH
  FROM txn_dirty GROUP BY _BATCH_ID)"""


def _gate1_verdict(spark: SparkSession, sf: str) -> DataFrame:
    judged = verdicts(_gate1(spark, sf), tx.mirror_suite(), BATCH)
    return judged.select("_BATCH_ID", "category", "metric", "value", "passed", "detail")


_CATEGORY = """CASE WHEN metric LIKE 'NULL%' THEN 'completeness' WHEN metric LIKE 'BAD_FMT%' OR metric LIKE 'BAD_CAST%'
  THEN 'column_type' WHEN metric LIKE 'BAD_DOMAIN%' THEN 'domain' WHEN metric LIKE 'DUP%' THEN 'uniqueness'
  WHEN metric = 'MISSING_SCHEMA_KEYS' THEN 'schema' ELSE 'volume' END"""
VERDICT_SQL = f"""verdict AS (SELECT _BATCH_ID, {_CATEGORY} AS category, metric, CAST(n AS DOUBLE) AS value,
  CASE WHEN metric = 'TOTAL_ROWS' THEN n >= 1 ELSE n = 0 END AS passed
  FROM (UNPIVOT gate1 ON COLUMNS(* EXCLUDE (_BATCH_ID)) INTO NAME metric VALUE n) u)"""


def _gate1_log(spark: SparkSession, sf: str) -> DataFrame:
    judged = _gate1_verdict(spark, sf)
    bad = F.array_sort(F.collect_list(F.when(~F.col("passed"), F.concat("metric", F.lit("="), F.col("value").cast("int").cast("string")))))
    return judged.groupBy("_BATCH_ID").agg(
        F.every("passed").alias("PASSED"),
        F.count(F.lit(1)).alias("TOTAL_CHECKS"),
        F.count_if(~F.col("passed")).alias("FAILED_COUNT"),
        F.array_join(bad, ";").alias("FAILED_DETAILS"),
        F.max(F.when(F.col("metric") == "TOTAL_ROWS", F.col("value"))).cast("bigint").alias("ROW_COUNT"),
    )


def _freshness(spark: SparkSession, sf: str) -> DataFrame:
    as_of = F.lit(b.EVENTS_AS_OF).cast("timestamp_ntz")
    events = b.table(spark, sf, "events")
    state = mt.freshness(events, "ts", as_of, timedelta(hours=4), timedelta(hours=12))
    return b.plain(state.withColumn("within_7_days", F.col("age_seconds") <= 7 * 86400))


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return tx.accepted_rows(tx.typed_rows(b.txn_dirty(spark, sf)))


STAGED = f"{b.DIRTY}, {b.typed_sql('txn_dirty')}"


def _gate2(spark: SparkSession, sf: str) -> DataFrame:
    rows = _staged(spark, sf)
    metrics = fused_metrics(rows, tx.staging_suite(), BATCH)
    metrics = attach(metrics, duplicate_metric(rows, "TXN_ID", "DUP_TXN_ID", BATCH), BATCH)
    return metrics.withColumn("MISSING_SCHEMA_COLS", F.lit(len(mt.missing_columns(rows, tx.KEYS))).cast("bigint"))


def _typed_metrics_sql(source: str, nulls: list[str]) -> str:
    return ", ".join(
        [f"count(*) FILTER ({c} IS NULL) AS NULL_{c}" for c in nulls]
        + [
            "count(*) FILTER (CURRENCY NOT IN ('USD','EUR','GBP','JPY','CHF')) AS BAD_DOMAIN_CURRENCY",
            "count(*) FILTER (STATUS NOT IN ('PENDING','SETTLED','CANCELLED','FAILED')) AS BAD_DOMAIN_STATUS",
            "count(*) FILTER (AMOUNT <= 0 OR AMOUNT > 100000000) AS BAD_RANGE_AMOUNT",
            "count(*) AS TOTAL_ROWS",
        ]
    )


GATE2_SQL = f"""WITH {STAGED} SELECT _BATCH_ID,
  {_typed_metrics_sql('typed_ok', ['TXN_ID', 'ACCOUNT_ID', 'AMOUNT', 'TXN_DATE'])},
  count(*) - count(DISTINCT TXN_ID) AS DUP_TXN_ID, CAST(0 AS BIGINT) AS MISSING_SCHEMA_COLS
  FROM typed_ok GROUP BY _BATCH_ID"""


def _gate3(spark: SparkSession, sf: str) -> DataFrame:
    return fused_metrics(tx.derive_mart(_staged(spark, sf)), tx.mart_suite(), BATCH)


GATE3_SQL = f"""WITH {STAGED}, {b.mart_sql('typed_ok')} SELECT _BATCH_ID,
  {_typed_metrics_sql('mart', ['TXN_ID', 'ACCOUNT_ID', 'AMOUNT', 'TXN_DATE', 'TXN_MONTH', 'TXN_YEAR'])},
  count(*) FILTER (TXN_MONTH <> date_trunc('month', TXN_DATE)) AS BAD_DERIVED_TXN_MONTH
  FROM mart GROUP BY _BATCH_ID"""


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A mart that lost every 97th row, and the staging table it came from."""
    raw = b.txn_raw(spark, sf)
    short = tx.typed_rows(raw.where(F.col("k") % 97 != 0))
    dims = ("ACCOUNT_ID", "CURRENCY")
    return (
        table_totals(short, "SDM", "AMOUNT", "TXN_ID", dims, "_LOADED_AT"),
        table_totals(tx.typed_rows(raw), "STG", "AMOUNT", "TXN_ID", dims, "_LOADED_AT"),
    )


def _consistency(spark: SparkSession, sf: str) -> DataFrame:
    judged = verdicts(consistency(*_sides(spark, sf)), tx.consistency_suite())
    return judged.select("metric", F.round("value", 4).alias("value"), "passed")


def _totals_sql(source: str) -> str:
    return (
        "SELECT sum(AMOUNT) AS amount, count(*) AS n, max(_LOADED_AT) AS latest, count(DISTINCT TXN_ID) AS ids, "
        f"count(DISTINCT ACCOUNT_ID) AS accts, count(DISTINCT CURRENCY) AS ccys FROM {source}"
    )


CONSISTENCY_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw', 'full_rows')},
short_src AS (SELECT * FROM txn_raw WHERE k % 97 <> 0), {b.typed_sql('short_src', 'short_rows')},
m AS ({_totals_sql('short_rows')}), s AS ({_totals_sql('full_rows')}),
v AS (
  SELECT 'amount_matches_stg' AS metric, CAST(abs(m.amount - s.amount) AS DOUBLE) AS value, 0.01 AS high FROM m, s
  UNION ALL SELECT 'row_count_within_1pct', abs(m.n - s.n) / CAST(greatest(s.n, 1) AS DOUBLE) * 100, 1.0 FROM m, s
  UNION ALL SELECT 'distinct_txn_id_matches_stg', abs(m.ids - s.ids), 0 FROM m, s
  UNION ALL SELECT 'all_accounts_in_sdm', s.accts - m.accts, 0 FROM m, s
  UNION ALL SELECT 'all_currencies_in_sdm', s.ccys - m.ccys, 0 FROM m, s
  UNION ALL SELECT 'sdm_within_30min_of_stg', date_diff('minute', m.latest, s.latest), 30 FROM m, s)
SELECT metric, round(value, 4) AS value, value <= high AS passed FROM v"""


def _members(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of staging that the short mart lacks, by comparing members instead of counts."""
    raw = b.txn_raw(spark, sf)
    return missing_references(raw, "TXN_ID", raw.where(F.col("k") % 97 != 0), "TXN_ID")


def _lag(spark: SparkSession, sf: str) -> DataFrame:
    events = b.table(spark, sf, "events")
    return b.plain(lag_minutes(events.where("event_type = 'signup'"), events, "ts"))


LAG_SQL = """WITH x AS (SELECT max(ts) FILTER (event_type = 'signup') AS behind_latest, max(ts) AS ahead_latest FROM events)
SELECT strftime(behind_latest, '%Y-%m-%d %H:%M:%S') AS behind_latest,
  strftime(ahead_latest, '%Y-%m-%d %H:%M:%S') AS ahead_latest,
  CAST(floor((epoch_us(ahead_latest) - epoch_us(behind_latest)) / 60000000.0) AS BIGINT) AS lag_minutes FROM x"""


def _model_tests(spark: SparkSession, sf: str) -> DataFrame:
    typed = tx.typed_rows(b.txn_dirty(spark, sf))
    tests = (
        [(f"not_null_{c}", mt.not_null(typed, c)) for c in ["TXN_ID", "ACCOUNT_ID", "AMOUNT", "TXN_DATE", "_BATCH_ID"]]
        + [("unique_TXN_ID", mt.unique(typed, "TXN_ID"))]
        + [("accepted_CURRENCY", mt.accepted_values(typed, "CURRENCY", tx.CURRENCIES))]
        + [("accepted_STATUS", mt.accepted_values(typed, "STATUS", tx.STATUSES))]
        + [("positive_AMOUNT", mt.positive(typed, "AMOUNT"))]
        + [("unique_l_orderkey", mt.unique(b.table(spark, sf, "lineitem"), "l_orderkey"))]
    )
    counted = [rows.agg(F.count(F.lit(1)).alias("failing")).select(F.lit(n).alias("test"), "failing") for n, rows in tests]
    return reduce(DataFrame.unionByName, counted)


def _model_tests_sql() -> str:
    parts = [
        f"SELECT 'not_null_{c}' AS test, count(*) AS failing FROM typed WHERE {c} IS NULL"
        for c in ["TXN_ID", "ACCOUNT_ID", "AMOUNT", "TXN_DATE", "_BATCH_ID"]
    ]
    parts += [
        "SELECT 'unique_TXN_ID', count(*) FROM (SELECT TXN_ID FROM typed WHERE TXN_ID IS NOT NULL GROUP BY 1 "
        "HAVING count(*) > 1) a",
        "SELECT 'accepted_CURRENCY', count(DISTINCT CURRENCY) FROM typed WHERE CURRENCY NOT IN "
        "('USD','EUR','GBP','JPY','CHF')",
        "SELECT 'accepted_STATUS', count(DISTINCT STATUS) FROM typed WHERE STATUS NOT IN "
        "('PENDING','SETTLED','CANCELLED','FAILED')",
        "SELECT 'positive_AMOUNT', count(*) FROM typed WHERE AMOUNT <= 0",
        "SELECT 'unique_l_orderkey', count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) c",
    ]
    return f"WITH {STAGED} " + " UNION ALL ".join(parts)


def _batch_profile(spark: SparkSession, sf: str) -> DataFrame:
    return b.plain(batch_profile(b.txn_raw(spark, sf), "_BATCH_ID", "TXN_ID", "_LOADED_AT", ["ACCOUNT_ID"]))


def _batch_profile_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that repeat within and across batches, so that distinct keys are fewer than rows."""
    return b.plain(batch_profile(b.txn_multi(spark, sf), "_BATCH_ID", "TXN_ID", "_LOADED_AT", ["l_suppkey"]))


QUERIES = {
    "gate1_metrics": Query(_gate1, f"WITH {b.DIRTY}, {GATE1_SQL} SELECT * FROM gate1"),
    "gate1_verdict": Query(
        _gate1_verdict,
        f"WITH {b.DIRTY}, {GATE1_SQL}, {VERDICT_SQL} SELECT *, CASE WHEN passed THEN 'value=' ELSE 'FAILED: value=' END "
        "|| CAST(value AS VARCHAR) AS detail FROM verdict",
    ),
    "gate1_log": Query(
        _gate1_log,
        f"""WITH {b.DIRTY}, {GATE1_SQL}, {VERDICT_SQL} SELECT _BATCH_ID, bool_and(passed) AS PASSED,
        count(*) AS TOTAL_CHECKS, count(*) FILTER (NOT passed) AS FAILED_COUNT,
        coalesce(string_agg(metric || '=' || CAST(CAST(value AS INTEGER) AS VARCHAR), ';'
          ORDER BY metric || '=' || CAST(CAST(value AS INTEGER) AS VARCHAR)) FILTER (NOT passed), '') AS FAILED_DETAILS,
        CAST(max(value) FILTER (metric = 'TOTAL_ROWS') AS BIGINT) AS ROW_COUNT FROM verdict GROUP BY _BATCH_ID""",
    ),
    "gate2_metrics": Query(_gate2, GATE2_SQL),
    "gate3_metrics": Query(_gate3, GATE3_SQL),
    "freshness_verdict": Query(
        _freshness,
        f"""WITH x AS (SELECT max(ts) AS latest FROM events), y AS (SELECT latest, CAST(floor(
          (epoch_us(TIMESTAMP '{b.EVENTS_AS_OF}') - epoch_us(latest)) / 1000000.0) AS BIGINT) AS age_seconds FROM x)
        SELECT strftime(latest, '%Y-%m-%d %H:%M:%S') AS latest, age_seconds,
          CASE WHEN age_seconds > 43200 THEN 'error' WHEN age_seconds > 14400 THEN 'warn' ELSE 'pass' END AS state,
          age_seconds <= 604800 AS within_7_days FROM y""",
    ),
    "cross_table_consistency": Query(_consistency, CONSISTENCY_SQL),
    "dimension_members": Query(_members, f"WITH {b.RAW} SELECT TXN_ID FROM txn_raw WHERE k % 97 = 0"),
    "table_lag": Query(_lag, LAG_SQL),
    "model_tests": Query(_model_tests, _model_tests_sql()),
    "batch_profile": Query(
        _batch_profile,
        f"""WITH {b.RAW} SELECT _BATCH_ID, count(*) AS total_rows, count(DISTINCT TXN_ID) AS distinct_keys,
        count(DISTINCT ACCOUNT_ID) AS "distinct_ACCOUNT_ID",
        strftime(min(_LOADED_AT), '%Y-%m-%d %H:%M:%S') AS earliest_load,
        strftime(max(_LOADED_AT), '%Y-%m-%d %H:%M:%S') AS latest_load FROM txn_raw GROUP BY _BATCH_ID""",
    ),
    "batch_profile_repeats": Query(
        _batch_profile_repeats,
        f"""WITH {b.MULTI} SELECT _BATCH_ID, count(*) AS total_rows, count(DISTINCT TXN_ID) AS distinct_keys,
        count(DISTINCT l_suppkey) AS "distinct_l_suppkey",
        strftime(min(_LOADED_AT), '%Y-%m-%d %H:%M:%S') AS earliest_load,
        strftime(max(_LOADED_AT), '%Y-%m-%d %H:%M:%S') AS latest_load FROM txn_multi GROUP BY _BATCH_ID""",
    ),
}
