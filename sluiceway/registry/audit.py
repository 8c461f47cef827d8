"""Questions to the audit tables, on audit rows derived from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators import audit as a
from sluiceway.operators.audit import AuditLog
from sluiceway.registry import base as b
from sluiceway.registry.base import Query
from sluiceway.session import scratch_dir


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    return b.plain(a.latest_results(b.audit_rows(spark, sf)))


LATEST = f"""{b.AUDIT}, latest AS (SELECT BATCH_ID, LAYER, RUN_AT, PASSED, EXECUTION_TIME_SECS, ROW_COUNT FROM (
  SELECT *, row_number() OVER (PARTITION BY BATCH_ID, LAYER
    ORDER BY RUN_AT DESC, EXECUTION_TIME_SECS DESC, ROW_COUNT DESC) AS rn FROM audit) t WHERE rn = 1)"""


def _timings(spark: SparkSession, sf: str) -> DataFrame:
    results = b.audit_rows(spark, sf)
    loads = results.groupBy("BATCH_ID").agg(F.min("RUN_AT").alias("INGEST_START"))
    return b.plain(a.phase_timings(results, loads))


def _start(layer: str) -> str:
    return f"max(RUN_AT - to_seconds(CAST(round(EXECUTION_TIME_SECS) AS INTEGER))) FILTER (LAYER = '{layer}') AS {layer}_s"


_WIDE = ", ".join(
    f"{_start(x)}, max(RUN_AT) FILTER (LAYER = '{x}') AS {x}_e, max(EXECUTION_TIME_SECS) FILTER (LAYER = '{x}') AS {x}_x"
    for x in a.LAYERS
)
TIMINGS_SQL = f"""WITH {LATEST}, loads AS (SELECT BATCH_ID, min(RUN_AT) AS i FROM audit GROUP BY 1),
w AS (SELECT BATCH_ID, {_WIDE}, max(ROW_COUNT) FILTER (LAYER = 'ML') AS ROWS_PROCESSED FROM latest GROUP BY 1),
c AS (SELECT * FROM w JOIN loads USING (BATCH_ID) WHERE ML_e IS NOT NULL AND STG_e IS NOT NULL AND SDM_e IS NOT NULL),
p AS (
  SELECT BATCH_ID, ROWS_PROCESSED, 'INGEST' AS PHASE, i AS s, ML_s AS e, epoch(ML_s) - epoch(i) AS d FROM c
  UNION ALL SELECT BATCH_ID, ROWS_PROCESSED, 'ML_TDQ', ML_s, ML_e, ML_x FROM c
  UNION ALL SELECT BATCH_ID, ROWS_PROCESSED, 'TRANSFORM', ML_e, STG_s, epoch(STG_s) - epoch(ML_e) FROM c
  UNION ALL SELECT BATCH_ID, ROWS_PROCESSED, 'STG_BDQ', STG_s, STG_e, STG_x FROM c
  UNION ALL SELECT BATCH_ID, ROWS_PROCESSED, 'SDM_BDQ', SDM_s, SDM_e, SDM_x FROM c),
t AS (SELECT BATCH_ID, max(ROWS_PROCESSED) AS ROWS_PROCESSED, min(s) AS s, max(e) AS e FROM p GROUP BY 1)
SELECT BATCH_ID, ROWS_PROCESSED, PHASE, strftime(s, '%Y-%m-%d %H:%M:%S') AS START_TS,
  strftime(e, '%Y-%m-%d %H:%M:%S') AS END_TS, CAST(d AS DOUBLE) AS DURATION_SEC FROM p
UNION ALL SELECT BATCH_ID, ROWS_PROCESSED, 'TOTAL_E2E', strftime(s, '%Y-%m-%d %H:%M:%S'),
  strftime(e, '%Y-%m-%d %H:%M:%S'), CAST(epoch(e) - epoch(s) AS DOUBLE) FROM t"""


def _alert(spark: SparkSession, sf: str) -> DataFrame:
    """Looks back two days, so that the sparse test events hold a failure."""
    as_of = F.lit(b.EVENTS_AS_OF).cast("timestamp_ntz")
    return a.alert_message(b.audit_rows(spark, sf), as_of, minutes=2880)


ALERT_SQL = f"""WITH {b.AUDIT} SELECT 'Layer: ' || LAYER || ' | Table: ' || TABLE_NAME || ' | Failed: ' || FAILED_COUNT ||
  '/' || TOTAL_CHECKS || ' | Time: ' || strftime(RUN_AT, '%Y-%m-%d %H:%M:%S') || ' | Batch: ' || BATCH_ID AS message
  FROM audit WHERE NOT PASSED AND RUN_AT >= TIMESTAMP '{b.EVENTS_AS_OF}' - INTERVAL 2880 MINUTE
  ORDER BY RUN_AT DESC, BATCH_ID DESC, LAYER DESC LIMIT 1"""


def _performance(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.audit_rows(spark, sf).withColumn("ROWS_PER_SECOND", F.col("ROW_COUNT") / (F.col("EXECUTION_TIME_SECS") + 1))
    out = a.performance_by_note(rows)
    return out.select("NOTES", F.round("AVG_TIME", 4).alias("AVG_TIME"), F.round("AVG_RPS", 3).alias("AVG_RPS"))


def _recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The latest runs with a matching note; a top-k report."""
    runs = b.audit_rows(spark, sf).where("ROW_COUNT is not null")
    return b.plain(a.runs_by_note(runs.select("BATCH_ID", "LAYER", "RUN_AT", "NOTES"), "%v2 error%"))


def _stored_results(spark: SparkSession, sf: str) -> DataFrame:
    """Audit rows appended to a stored result table and read back, details as an object."""
    log = AuditLog(spark, scratch_dir(spark, "audit"))
    rows = b.audit_rows(spark, sf).withColumn(
        "FAILED_DETAILS", F.parse_json(F.to_json(F.struct(F.col("FAILED_COUNT").alias("n"))))
    )
    log.append("TDQ_RESULTS", rows)
    stored = log.table("TDQ_RESULTS").withColumn("failed", F.variant_get("FAILED_DETAILS", "$.n", "bigint"))
    return stored.groupBy("LAYER", "PASSED").agg(
        F.count(F.lit(1)).alias("results"), F.sum("failed").alias("failed"), F.sum("ROW_COUNT").alias("row_total")
    )


def _batches_passed(spark: SparkSession, sf: str) -> DataFrame:
    """Batches whose latest first-gate result is a pass."""
    latest = a.latest_results(b.audit_rows(spark, sf).where("LAYER = 'ML'"))
    return latest.where("PASSED").select("BATCH_ID")


QUERIES = {
    "latest_audit_by_layer": Query(
        _latest,
        f"WITH {LATEST} SELECT * REPLACE (strftime(RUN_AT, '%Y-%m-%d %H:%M:%S') AS RUN_AT) FROM latest",
    ),
    "phase_timing": Query(_timings, TIMINGS_SQL),
    "alert_message": Query(_alert, ALERT_SQL),
    "run_performance": Query(
        _performance,
        f"""WITH {b.AUDIT} SELECT NOTES, round(avg(EXECUTION_TIME_SECS), 4) AS AVG_TIME,
        round(avg(ROW_COUNT / (EXECUTION_TIME_SECS + 1)), 3) AS AVG_RPS FROM audit GROUP BY NOTES""",
    ),
    "recent_runs": Query(
        _recent_runs,
        f"""WITH {b.AUDIT} SELECT BATCH_ID, LAYER, strftime(RUN_AT, '%Y-%m-%d %H:%M:%S') AS RUN_AT, NOTES FROM audit
        WHERE NOTES LIKE '%v2 error%' ORDER BY audit.RUN_AT DESC, BATCH_ID DESC, LAYER DESC, NOTES DESC LIMIT 20""",
    ),
    "audit_append": Query(
        _stored_results,
        f"""WITH {b.AUDIT} SELECT LAYER, PASSED, count(*) AS results, CAST(sum(FAILED_COUNT) AS BIGINT) AS failed,
        CAST(sum(ROW_COUNT) AS BIGINT) AS row_total FROM audit GROUP BY LAYER, PASSED""",
    ),
    "batches_passed": Query(
        _batches_passed, f"WITH {LATEST} SELECT BATCH_ID FROM latest WHERE LAYER = 'ML' AND PASSED"
    ),
}
