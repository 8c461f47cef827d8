"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and is then timed; a query that writes tables
includes the writing.  `phases` loads one batch and takes it through the gates,
with the time of each phase, on all line items.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import functions as F

from sluiceway.functions.scalars import pad_number
from sluiceway.operators.verdict import GateFailed
from sluiceway.plans import cycle, gates
from sluiceway.plans import transactions as tx
from sluiceway.plans.store import Store
from sluiceway.registry import all_queries
from sluiceway.registry import base as b
from sluiceway.session import build_session, scratch_dir
from sluiceway.sources.listing import pending_files
from sluiceway.sources.loading import load_csv, load_parquet
from sluiceway.sources.unload import unload_csv, unload_parquet

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
REPEATS = int(os.environ.get("BENCH_REPEATS", "1"))
HEADLINE = [
    "gate1_metrics", "gate1_verdict", "gate2_metrics", "gate3_metrics", "cross_table_consistency", "cross_batch_dups",
    "newest_batch_repeats", "ref_integrity", "provenance", "dedupe_latest", "typed_staging", "upsert_merge",
    "incremental_slice", "mart_derived", "mart_refresh_affected", "batch_profile", "load_acceptance",
    "technical_columns", "new_files", "header_groups", "model_tests", "group_checks_events", "group_checks_documents",
    "variant_extract", "latest_audit_by_layer", "phase_timing", "freshness_verdict",
    "csv_batch_load", "stored_merge", "cycle_mart", "stream_repeats", "stream_verdicts", "late_passed_batch",
]


def run_query(spark, query) -> None:
    """Compute every output column of every row without moving them to the driver."""
    query.run(spark, SF_DIR).write.format("noop").mode("overwrite").save()


def payload_of_line_items(spark):
    """Transaction texts with one unique key per line item."""
    li = b.table(spark, SF_DIR, "lineitem").withColumn("n", F.monotonically_increasing_id())
    raw = b.txn_raw(spark, SF_DIR).select("k", "ACCOUNT_ID", "INSTRUMENT_ID", "CURRENCY", "STATUS")
    return li.join(raw, F.col("l_orderkey") == F.col("k")).select(
        F.concat(F.lit("TXN-"), pad_number(F.col("n"), 10)).alias("TXN_ID"), "ACCOUNT_ID", "INSTRUMENT_ID",
        F.col("l_extendedprice").cast("decimal(18,4)").cast("string").alias("AMOUNT"), "CURRENCY",
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("TXN_DATE"),
        F.date_format(F.date_add(F.col("l_shipdate").cast("date"), 2), "yyyy-MM-dd").alias("SETTLEMENT_DATE"), "STATUS",
    )


def run_phases(spark) -> tuple[dict[str, float], int]:
    landing = scratch_dir(spark, "bench-landing")
    store = Store(spark, scratch_dir(spark, "bench"), b.accounts(spark, SF_DIR), b.instruments(spark, SF_DIR))
    rows = payload_of_line_items(spark).repartition(16).persist()
    unload_parquet(rows, f"{landing}/a")
    csv_landing = scratch_dir(spark, "bench-csv")
    unload_csv(rows, f"{csv_landing}/a")
    count = rows.count()
    rows.unpersist()
    csv_store = Store(spark, scratch_dir(spark, "bench"), store.accounts, store.instruments)
    took: dict[str, float] = {}

    def phase(name, work):
        began = time.time()
        result = work()
        took[name] = round(time.time() - began, 3)
        return result

    context = {"BATCH_ID": "bench"}
    files = pending_files(spark, landing, store.mirror)
    texts = pending_files(spark, csv_landing, csv_store.mirror)
    phase("phase_load_csv", lambda: load_csv(spark, csv_store.mirror, texts, context, base=csv_landing))
    phase("phase_load", lambda: load_parquet(spark, store.mirror, files, context, base=landing))
    phase("phase_gate1", lambda: gates.gate_mirror(store, "bench"))
    phase("phase_transform", lambda: cycle.stage_new_rows(store))
    phase("phase_gate2", lambda: gates.gate_staging(store, "bench"))

    def refresh_and_check():
        cycle.refresh_mart(store)
        return gates.gate_mart(store, "bench")

    phase("phase_refresh_gate3", refresh_and_check)

    # The steady state: a second batch with rows that replace old ones, and repeats that stop gate 1.
    again = payload_of_line_items(spark)
    number = F.substring("TXN_ID", 5, 10).cast("bigint")
    replaced = again.where(number % 20 == 0).withColumn("STATUS", F.lit("PENDING"))
    added = again.where(number % 10 == 1).withColumn("TXN_ID", F.concat(F.lit("TXN-9"), F.substring("TXN_ID", 6, 9)))
    unload_parquet(replaced.unionByName(added).repartition(8), f"{landing}/b")
    files = pending_files(spark, landing, store.mirror)
    phase("phase2_load", lambda: load_parquet(spark, store.mirror, files, {"BATCH_ID": "second"}, base=landing))

    def gate_with_repeats():
        try:
            gates.gate_mirror(store, "second")
        except GateFailed:
            return
        raise RuntimeError("repeated keys were not found")

    phase("phase2_gate1", gate_with_repeats)
    store.approve("second")
    phase("phase2_transform", lambda: cycle.stage_new_rows(store))
    phase("phase2_gate2", lambda: gates.gate_staging(store, "second"))

    def refresh_and_check_again():
        cycle.refresh_mart(store)
        return gates.gate_mart(store, "second")

    phase("phase2_refresh_gate3", refresh_and_check_again)
    return took, count


def main() -> None:
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    registered, times = all_queries(), {}
    for name in HEADLINE:
        run_query(spark, registered[name])
        taken = []
        for _ in range(REPEATS):
            began = time.time()
            run_query(spark, registered[name])
            taken.append(time.time() - began)
        times[name] = round(statistics.median(taken), 3)
    run_phases(spark)
    phases, rows = run_phases(spark)
    times.update(phases)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "rows_per_second": {n: round(rows / s) for n, s in phases.items() if not n.startswith("phase2")},
                "phase_rows": rows,
                "sf": os.path.basename(SF_DIR).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
