"""Audit tables: what was checked, when, how long it took, and what to report."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.sources.rowlog import RowLog

# The audit tables and their columns.
AUDIT_SCHEMAS = {
    "TDQ_RESULTS": (
        "RESULT_ID string, BATCH_ID string, TABLE_NAME string, LAYER string, CHECK_TYPE string, "
        "RUN_AT timestamp_ntz, PASSED boolean, TOTAL_CHECKS bigint, FAILED_COUNT bigint, FAILED_DETAILS variant, "
        "ROW_COUNT bigint, EXECUTION_TIME_SECS double, WAREHOUSE_SIZE string, SUITE_NAME string"
    ),
    "PIPELINE_RUNS": (
        "RUN_ID string, BATCH_ID string, RUN_AT timestamp_ntz, STATUS string, ML_TDQ_PASSED boolean, "
        "STG_BDQ_PASSED boolean, SDM_BDQ_PASSED boolean, TOTAL_TIME_SECS double, NOTES string"
    ),
    "PERFORMANCE_BENCHMARKS": (
        "BENCHMARK_ID string, RUN_AT timestamp_ntz, LAYER string, CHECK_CATEGORY string, ROW_COUNT bigint, "
        "DATA_SIZE_GB double, WAREHOUSE_SIZE string, EXECUTION_TIME_SECS double, ROWS_PER_SECOND double, NOTES string"
    ),
    "STRESS_TEST_RESULTS": (
        "TEST_RUN_ID string, PHASE string, START_TS timestamp_ntz, END_TS timestamp_ntz, DURATION_SEC double, "
        "ROWS_PROCESSED bigint, FILES_PROCESSED bigint, ROWS_PER_SEC double, WAREHOUSE_SIZE string, NOTES string, "
        "CREATED_AT timestamp_ntz"
    ),
}
LAYERS = ["ML", "STG", "SDM"]


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class AuditLog:
    """Append-only tables below one folder; see `RowLog` for how they are stored."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def log(self, name: str) -> RowLog:
        return RowLog(self.spark, f"{self.path}/{name}", AUDIT_SCHEMAS[name])

    def table(self, name: str) -> DataFrame:
        return self.log(name).read()

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows; columns not given are NULL.  Now and then this gathers the small files of earlier rows."""
        empty = self.spark.createDataFrame([], AUDIT_SCHEMAS[name])
        typed = rows.select(*[F.col(f.name).cast(f.dataType) for f in empty.schema if f.name in rows.columns])
        self.log(name).append(empty.unionByName(typed, allowMissingColumns=True))

    def delete_where(self, name: str, condition: Column) -> None:
        """Remove matching rows; readers see the table before or after it, never without its rows."""
        self.log(name).rewrite(lambda rows: rows.where(~F.coalesce(condition, F.lit(False))))

    def compact(self, name: str) -> None:
        self.log(name).compact()

    def add(self, name: str, **values) -> None:
        """Add one row; the key and the time stamp are filled in."""
        key = AUDIT_SCHEMAS[name].split(" ", 1)[0]
        row = {"RUN_AT": utc_now(), **values}
        columns = {k: F.lit(v) for k, v in row.items() if k in AUDIT_SCHEMAS[name]}
        if "FAILED_DETAILS" in values:
            columns["FAILED_DETAILS"] = F.parse_json(F.lit(json.dumps(values["FAILED_DETAILS"])))
        columns.setdefault(key, F.uuid())
        one = self.spark.range(1).select(*[c.alias(n) for n, c in columns.items()])
        self.append(name, one)


def latest_results(results: DataFrame) -> DataFrame:
    """Newest row per batch and layer, for all layers in one pass."""
    fields = ["RUN_AT", "PASSED", "EXECUTION_TIME_SECS", "ROW_COUNT"]
    newest = F.max_by(F.struct(*fields), F.struct("RUN_AT", "EXECUTION_TIME_SECS", "ROW_COUNT"))
    return results.groupBy("BATCH_ID", "LAYER").agg(newest.alias("r")).select("BATCH_ID", "LAYER", "r.*")


def _seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end).cast("double")


def phase_timings(results: DataFrame, loads: DataFrame) -> DataFrame:
    """Start, end and duration of the five phases of each batch, and of the whole.

    A gate started its execution time before its result was written.  Loading ends
    where the first gate starts; the transform fills the time between two gates.
    `loads` gives (BATCH_ID, INGEST_START).  Batches without all three gates are left out.
    """
    started = F.timestamp_add("SECOND", -F.round("EXECUTION_TIME_SECS").cast("int"), F.col("RUN_AT"))
    timed = latest_results(results).withColumn("START", started)
    wide = timed.groupBy("BATCH_ID").agg(
        *[
            F.max(F.when(F.col("LAYER") == layer, F.col(source))).alias(f"{layer}_{name}")
            for layer in LAYERS
            for name, source in [("START", "START"), ("END", "RUN_AT"), ("SECS", "EXECUTION_TIME_SECS"),
                                 ("ROWS", "ROW_COUNT")]
        ]
    )
    complete = wide.where(" and ".join(f"{layer}_END is not null" for layer in LAYERS)).join(loads, "BATCH_ID")
    c = F.col
    spans = [
        ("INGEST", c("INGEST_START"), c("ML_START"), _seconds(c("INGEST_START"), c("ML_START"))),
        ("ML_TDQ", c("ML_START"), c("ML_END"), c("ML_SECS")),
        ("TRANSFORM", c("ML_END"), c("STG_START"), _seconds(c("ML_END"), c("STG_START"))),
        ("STG_BDQ", c("STG_START"), c("STG_END"), c("STG_SECS")),
        ("SDM_BDQ", c("SDM_START"), c("SDM_END"), c("SDM_SECS")),
    ]
    first, last = F.least(*[s for _, s, _, _ in spans]), F.greatest(*[e for _, _, e, _ in spans])
    spans.append(("TOTAL_E2E", first, last, _seconds(first, last)))
    rows = [
        F.struct(F.lit(p).alias("PHASE"), s.alias("START_TS"), e.alias("END_TS"), d.alias("DURATION_SEC"))
        for p, s, e, d in spans
    ]
    return complete.select("BATCH_ID", F.col("ML_ROWS").alias("ROWS_PROCESSED"), F.inline(F.array(*rows)))


def alert_message(results: DataFrame, as_of: Column, minutes: int = 10) -> DataFrame:
    """One message about the latest failure, or no row if none is recent enough."""
    failed = results.where(~F.col("PASSED"))
    recent = failed.where(F.col("RUN_AT") >= F.timestamp_add("MINUTE", F.lit(-minutes), as_of))
    # The pieces of the message.
    text = F.concat(
        F.lit("Layer: "), "LAYER",
        F.lit(" | Table: "), "TABLE_NAME",
        F.lit(" | Failed: "), F.col("FAILED_COUNT").cast("string"), F.lit("/"), F.col("TOTAL_CHECKS").cast("string"),
        F.lit(" | Time: "), F.date_format("RUN_AT", "yyyy-MM-dd HH:mm:ss"),
        F.lit(" | Batch: "), "BATCH_ID",
    )
    return recent.orderBy(F.desc("RUN_AT"), F.desc("BATCH_ID"), F.desc("LAYER")).limit(1).select(text.alias("message"))


def runs_by_note(runs: DataFrame, pattern: str, limit: int = 20) -> DataFrame:
    """Latest runs whose note matches; runs of one moment in order of their other columns."""
    ties = [F.desc(c) for c in sorted(runs.columns) if c != "RUN_AT"]
    return runs.where(F.col("NOTES").like(pattern)).orderBy(F.desc("RUN_AT"), *ties).limit(limit)


def performance_by_note(benchmarks: DataFrame) -> DataFrame:
    """Average time and throughput per note, fastest first."""
    return (
        benchmarks.groupBy("NOTES")
        .agg(F.avg("EXECUTION_TIME_SECS").alias("AVG_TIME"), F.avg("ROWS_PER_SECOND").alias("AVG_RPS"))
        .orderBy("AVG_TIME")
    )
