"""Steps of one run and the run itself: load, gate, transform, gate, refresh, gate, log."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.audit import phase_timings
from sluiceway.operators.keys import latest_part, latest_per_key
from sluiceway.operators.upsert import Merged, merge_into
from sluiceway.operators.verdict import GateFailed
from sluiceway.plans import transactions as tx
from sluiceway.plans.gates import GateResult, gate_mart, gate_mirror, gate_staging
from sluiceway.plans.ledger import LOADED, PASSED, STAGED, VERIFIED
from sluiceway.plans.store import MONTH, Store
from sluiceway.sources.listing import pending_files
from sluiceway.sources.loading import LoadSummary, load_csv, load_parquet
from sluiceway.sources.tables import PartTable

LOADERS = {"parquet": load_parquet, "csv": load_csv}


@dataclass
class CycleResult:
    status: str
    batch_id: str | None = None
    load: LoadSummary | None = None
    gates: list[GateResult] = field(default_factory=list)
    failed: list[str] = field(default_factory=list)
    # Batches that earlier runs had left before the end, and what this run made of them.
    caught_up: list[CycleResult] = field(default_factory=list)


def stage_new_rows(store: Store) -> Merged | None:
    """Typed rows of the passed deliveries, merged by key; None if there are none.

    What is left to do follows from the ledger, not from load times, so a batch that passes late is taken up, and of
    a batch that was delivered twice just the deliveries that passed.  A late row does not replace a newer one.
    The changed keys are noted before they show, for the mart.
    """
    row = "_FILE_ROW_NUM"
    waiting = store.waiting(PASSED)
    if not waiting:
        return None
    mirror = tx.mirror_keys(store.mirror.read(set(waiting)), row)
    accepted = tx.accepted_rows(tx.typed_rows(mirror, row))
    rows = latest_per_key(accepted, ["TXN_ID"], tx.newest_first(row)).drop(row)

    def note(merged: Merged) -> None:
        store.note_change(merged.version, merged.arriving, merged.replaced)

    merged = merge_into(store.staging, rows, ["TXN_ID"], carry=["TXN_DATE"], age="_LOADED_AT", ready=note)
    store.ledger.record(waiting, STAGED)
    return merged


MOSTLY = 0.6  # share of the mart's rows in changed months from which everything is derived anew


def _rows_of(table: PartTable) -> dict[str, int]:
    """Rows per part of a table, from its log; one entry per part."""
    sizes = table.items().groupBy("part").agg(F.sum("rows").alias("n"))
    return {r.part: r.n for r in sizes.collect()}


def _with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn(MONTH, F.col("TXN_MONTH").cast("string"))


def rebuild_mart(store: Store) -> None:
    """Recompute every row of the mart."""
    notes, gone = store.open_changes(), list(store.mart.live_parts())
    most = sum(_rows_of(store.staging).values())
    rows = tx.derive_months(store.staging.read(), most=most)
    store.mart.replace(_with_month(rows), drop=gone, spread=True)
    store.forget_changes(notes)


def refresh_mart(store: Store) -> bool:
    """Bring the mart up to staging, whatever earlier runs left undone; False if nothing was.

    Works off the noted changes: only the months of their rows are read from the mart and rewritten,
    only the parts that received the rows are read from staging.  Keys are compared only where rows from before the change
    can be: not in months the mart does not have, nor in parts that show nothing but what came.  If the changed months hold most of the mart, all of
    it is derived from staging, which saves joining.  A run that dies before the notes are
    dropped repeats the same refresh.
    """
    notes = store.open_changes()
    if store.mart.is_empty():
        if store.staging.is_empty():
            return False
        rebuild_mart(store)
        return True
    if not notes:
        return False
    changes = store.changes(notes)
    # Versions, batch names and months: one per merge, per part written since the last refresh and per month of its rows.
    came = changes.where("version IS NOT NULL").select("version", "part").distinct().collect()
    fresh = store.staging.stored(*{r.version for r in came}).select("TXN_ID", "TXN_DATE")
    changed = fresh.unionByName(changes.where("TXN_ID IS NOT NULL").select("TXN_ID", "TXN_DATE"))
    month = F.trunc("TXN_DATE", "month").cast("string")
    hit = sorted(r[0] for r in changed.select(month).distinct().collect())
    sizes = _rows_of(store.mart)
    if sum(sizes.get(m, 0) for m in hit) >= MOSTLY * sum(sizes.values()):
        rebuild_mart(store)
        return True
    keys = changed.select("TXN_ID").distinct()
    live, arrived = store.staging.live_parts(), {(r.part, r.version) for r in came}
    shown = {(part, v) for part in {r.part for r in came} for v in live.get(part, [])}
    again = store.staging.read(shown)
    if shown - arrived:  # some rows of these parts were there before
        again = again.join(keys, "TXN_ID", "left_semi")
    again = again.select(tx.MONTH_COLUMNS)
    if any(sizes.get(m) for m in hit):
        old = store.mart.read().where(F.col(MONTH).isin(hit)).join(keys, "TXN_ID", "left_anti")
        again = old.select(tx.MONTH_COLUMNS).unionByName(again)
    staged = _rows_of(store.staging)
    most = max((sizes.get(m, 0) for m in hit), default=0) + sum(staged.get(r.part, 0) for r in came)
    store.mart.replace(_with_month(tx.derive_months(again, most=most)), drop=hit, spread=True)
    store.forget_changes(notes)
    return True


def log_timings(store: Store, batch_id: str, size: str = "") -> DataFrame:
    """Derive the phase timings of a batch from the audit rows and append them."""
    mine = store.mirror.read().where(F.col("_BATCH_ID") == batch_id)
    loads = mine.groupBy(F.col("_BATCH_ID").alias("BATCH_ID")).agg(F.min("_LOADED_AT").alias("INGEST_START"))
    results = store.audit.table("TDQ_RESULTS").where(F.col("BATCH_ID") == batch_id)
    loaded = store.mirror.items().where(F.col("part") == batch_id)
    files = loaded.groupBy(F.col("part").alias("BATCH_ID")).agg(F.count("item").alias("FILES_PROCESSED"))
    timed = phase_timings(results, loads).join(files, "BATCH_ID").select(
        F.col("BATCH_ID").alias("TEST_RUN_ID"), "PHASE", "START_TS", "END_TS", "DURATION_SEC", "ROWS_PROCESSED",
        "FILES_PROCESSED", (F.col("ROWS_PROCESSED") / F.nullif("DURATION_SEC", F.lit(0))).alias("ROWS_PER_SEC"),
        F.lit(size).alias("WAREHOUSE_SIZE"), F.concat(F.lit("batch_id="), "BATCH_ID").alias("NOTES"),
        F.current_timestamp().alias("CREATED_AT"),
    )
    store.audit.append("STRESS_TEST_RESULTS", timed)
    return timed


def newest_batch(rows: DataFrame) -> str | None:
    return latest_part(rows, "_BATCH_ID", "_LOADED_AT").first()[0]


def run_cycle(
    store: Store,
    landing: str,
    file_format: str = "parquet",
    context: dict | None = None,
    metadata: dict | None = None,
    as_of: datetime | None = None,
    size: str = "",
) -> CycleResult:
    """One run over whatever has landed, and over what earlier runs left before the end.

    Every delivery goes on from the state in which the ledger has it, so nothing depends on the run that loaded it.  A batch
    stops at its first failed gate, after logging it; the others go on.  An error of any kind is logged as a
    failed run before it is raised.  The result is that of the batch loaded now, or of the last one caught up.
    """
    began = time.time()
    results: dict[str, CycleResult] = {}
    batch_id, load = (context or {}).get("BATCH_ID"), None
    try:
        files = pending_files(store.spark, landing, store.mirror, f"*.{file_format}")
        load = LOADERS[file_format](store.spark, store.mirror, files, context, metadata, base=landing)
        if load.status != "EMPTY":
            batch_id = load.batch_id
        _work_off(store, results, as_of, size)
    except Exception as problem:
        broken = results.get(batch_id) or CycleResult("FAILED", batch_id, load)
        broken.status = "FAILED"
        broken.failed.append(f"{'run' if load else 'load'}: {type(problem).__name__}")
        _log_run(store, broken, time.time() - began)
        raise
    for result in results.values():
        _log_run(store, result, time.time() - began)
        if result.status == "SUCCESS":
            log_timings(store, result.batch_id, size)
    if not results:
        return CycleResult("EMPTY", load=load)
    own = results.pop(batch_id if batch_id in results else next(reversed(results)))
    own.load, own.caught_up = load, list(results.values())
    return own


def _work_off(store: Store, results: dict[str, CycleResult], as_of: datetime | None, size: str) -> None:
    """Bring all open deliveries as far as they get; `results` has an entry per batch that was worked on."""

    def attempt(state: str, gate: Callable[[str], GateResult], last: bool = False) -> None:
        # A few batches at most: those of this run and of runs that broke off.
        for batch in sorted({b for b, _ in store.waiting(state)}):
            result = results.setdefault(batch, CycleResult("RUNNING", batch))
            try:
                result.gates.append(gate(batch))
                result.status = "SUCCESS" if last else result.status
            except GateFailed as stop:
                result.status, result.failed = "FAILED", stop.failed

    attempt(LOADED, lambda batch: gate_mirror(store, batch, as_of, size))
    stage_new_rows(store)
    attempt(STAGED, lambda batch: gate_staging(store, batch, size))
    if store.waiting(VERIFIED):
        # The refresh belongs to the time of the third gate.
        refreshing = time.time()
        refresh_mart(store)
        attempt(VERIFIED, lambda batch: gate_mart(store, batch, size, refreshing), last=True)


def _log_run(store: Store, result: CycleResult, seconds: float) -> None:
    passed = {g.layer: g.success for g in result.gates}
    store.audit.add(
        "PIPELINE_RUNS", BATCH_ID=result.batch_id, STATUS=result.status, ML_TDQ_PASSED=passed.get("ML", False),
        STG_BDQ_PASSED=passed.get("STG", False), SDM_BDQ_PASSED=passed.get("SDM", False), TOTAL_TIME_SECS=seconds,
        NOTES="; ".join(result.failed) or "all gates passed",
    )

