"""The three gates: profile a batch, judge it, log the outcome, stop if it failed."""

from __future__ import annotations

import time
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from sluiceway.functions.metrics import Check
from sluiceway.operators.audit import AuditLog, utc_now
from sluiceway.operators.keys import KeyBounds, key_metrics, keys_without_origin, missing_references
from sluiceway.operators.modeltests import missing_columns
from sluiceway.operators.profile import attach, duplicate_metric, fused_metrics
from sluiceway.operators.reconcile import compared, fact_totals, with_key_counts
from sluiceway.operators.verdict import EmptyBatch, GateFailed, judge
from sluiceway.plans import transactions as tx
from sluiceway.plans.ledger import FAILED, PASSED, REJECTED, SERVED, VERIFIED, Delivery
from sluiceway.plans.store import Store
from sluiceway.session import fits_broadcast

CHECK_TYPES = {"ML": "TDQ", "STG": "TDQ+BDQ", "SDM": "BDQ"}
# What a gate makes of the deliveries it saw, by its outcome.
OUTCOMES = {"ML": (PASSED, FAILED), "STG": (VERIFIED, REJECTED), "SDM": (SERVED, REJECTED)}


@dataclass(frozen=True)
class GateResult:
    layer: str
    table: str
    batch_id: str
    success: bool
    batch_rows: int
    total_rows: int
    checks: list[Row] = field(repr=False)
    seconds: float = 0.0

    @property
    def failed(self) -> list[str]:
        return [f"{r.metric}: {r.detail}" for r in self.checks if not r.passed]


def gate_mirror(store: Store, batch_id: str, as_of: datetime | None = None, size: str = "") -> GateResult:
    """First gate: 17 checks on one batch of the mirror.

    The fused metrics of the batch also give the bound on its keys.  If that is small, filters name the other
    batches that may hold one of them, and only these are read by the key pass; mostly there are none.  The outcome
    holds for the deliveries the mirror showed at the beginning.
    """
    began, seen = time.time(), store.deliveries(batch_id)
    rows = tx.mirror_keys(store.mirror.read())
    batch = rows.where(F.col("_BATCH_ID") == batch_id)
    suite = tx.mirror_suite(_literal(as_of))
    first = fused_metrics(batch, [*suite, *KeyBounds.metrics("TXN_ID")]).first()
    if first.TOTAL_ROWS == 0:
        raise _empty(store, "ML", "mirror", batch_id, began, size, seen)
    bounds = KeyBounds.of(first.TOTAL_ROWS, first)
    others = store.mirror.live_parts().keys() - {batch_id}
    history = rows.where(F.col("_BATCH_ID") != batch_id) if others else None
    if others and fits_broadcast(bounds.rows, bounds.longest):
        near = {pair for pair in store.mirror.may_hold(batch.select("TXN_ID"), bounds.rows) if pair[0] != batch_id}
        history = tx.mirror_keys(store.mirror.read(near)) if near else None
    keys = key_metrics(batch, history, "TXN_ID", bounds, "DUP_TXN_ID_IN_BATCH", "cross_batch_dup_txn_ids")
    values = {**first.asDict(), **keys.first().asDict()}
    return _conclude(store, "ML", "mirror", batch_id, values, suite, began, size, seen, log_speed=True)


def gate_staging(store: Store, batch_id: str, size: str = "") -> GateResult:
    """Second gate: 13 checks on one batch of staging.

    The reference checks read one column each.  Batch ids are parts of both tables,
    so provenance compares their logs and reads no rows.
    """
    began, seen = time.time(), store.deliveries(batch_id)
    table = store.staging.read()
    batch = table.where(F.col("_BATCH_ID") == batch_id)
    suite = tx.staging_suite()
    metrics = fused_metrics(batch, suite)
    staged, known = store.staging.items(), store.mirror.items()
    for more in [
        duplicate_metric(batch, "TXN_ID", "DUP_TXN_ID"),
        _count(missing_references(batch, "ACCOUNT_ID", store.accounts, "ACCOUNT_ID"), "BAD_REF_ACCOUNT"),
        _count(missing_references(batch, "INSTRUMENT_ID", store.instruments, "INSTRUMENT_ID"), "BAD_REF_INSTRUMENT"),
        _count(keys_without_origin(staged, known, "part"), "batch_ids_exist_in_mirror"),
    ]:
        metrics = attach(metrics, more)
    values = metrics.first().asDict()
    values["MISSING_SCHEMA_COLS"] = len(missing_columns(table, tx.KEYS))
    if values["TOTAL_ROWS"] == 0:
        raise _empty(store, "STG", "staging", batch_id, began, size, seen)
    return _conclude(store, "STG", "staging", batch_id, values, suite, began, size, seen)


def gate_mart(store: Store, batch_id: str, size: str = "", began: float | None = None) -> GateResult:
    """Third gate: 11 checks on one batch of the mart, 6 between mart and staging.

    The tables are compared by the facts stored with their parts.  If these show the same keys, neither is read;
    else the key columns are, for the exact difference.  `began` is when the refresh before it began, so that the
    phase holds both.
    """
    began, seen = began or time.time(), store.deliveries(batch_id)
    mart, staging = store.mart, store.staging
    suite = tx.mart_suite() + tx.consistency_suite()
    batch = fused_metrics(mart.read().where(F.col("_BATCH_ID") == batch_id), tx.mart_suite()).first()
    totals = fact_totals({"SDM": mart.read_facts(), "STG": staging.read_facts()}, ("ACCOUNT_ID", "CURRENCY"))
    both = with_key_counts(totals["SDM"], totals["STG"], "TXN_ID", mart.read(), staging.read())
    values = {**batch.asDict(), **compared(both).first().asDict()}
    if values["TOTAL_ROWS"] == 0:
        raise _empty(store, "SDM", "mart", batch_id, began, size, seen)
    return _conclude(store, "SDM", "mart", batch_id, values, suite, began, size, seen)


def _literal(as_of: datetime | None) -> Column:
    return F.lit(str(as_of or utc_now())).cast("timestamp_ntz")


def _count(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias(name))


def _conclude(
    store: Store, layer: str, table: str, batch_id: str, values: dict, suite: list[Check], began: float, size: str,
    seen: list[Delivery], log_speed: bool = False,
) -> GateResult:
    """Judge the values, write the audit row and the ledger whatever the outcome, then stop on failure."""
    checks = judge(values, suite)
    rows, seconds = int(values["TOTAL_ROWS"]), time.time() - began
    result = GateResult(
        layer, table, batch_id, all(r.passed for r in checks), rows, int(values.get("TABLE_ROWS", rows)), checks,
        seconds,
    )
    _log(store.audit, result, size)
    store.ledger.record(seen, OUTCOMES[layer][0 if result.success else 1])
    if log_speed:
        store.audit.add(
            "PERFORMANCE_BENCHMARKS", LAYER=layer, CHECK_CATEGORY="fused_metrics", ROW_COUNT=rows,
            WAREHOUSE_SIZE=size, EXECUTION_TIME_SECS=seconds, ROWS_PER_SECOND=round(rows / seconds) + 0.0,
            NOTES=f"fused metrics ({rows} rows)",
        )
    if not result.success:
        raise GateFailed(layer, batch_id, result.failed)
    return result


def _log(audit: AuditLog, result: GateResult, size: str) -> None:
    audit.add(
        "TDQ_RESULTS", BATCH_ID=result.batch_id, TABLE_NAME=result.table, LAYER=result.layer,
        CHECK_TYPE=CHECK_TYPES[result.layer], PASSED=result.success, TOTAL_CHECKS=len(result.checks),
        FAILED_COUNT=len(result.failed), FAILED_DETAILS=result.failed, ROW_COUNT=result.batch_rows,
        EXECUTION_TIME_SECS=result.seconds, WAREHOUSE_SIZE=size, SUITE_NAME=f"{result.table}_{result.layer.lower()}",
    )


def _empty(
    store: Store, layer: str, table: str, batch_id: str, began: float, size: str, seen: list[Delivery]
) -> EmptyBatch:
    store.audit.add(
        "TDQ_RESULTS", BATCH_ID=batch_id, TABLE_NAME=table, LAYER=layer, CHECK_TYPE=CHECK_TYPES[layer], PASSED=False,
        TOTAL_CHECKS=1, FAILED_COUNT=1, FAILED_DETAILS=["no rows"], ROW_COUNT=0,
        EXECUTION_TIME_SECS=time.time() - began, WAREHOUSE_SIZE=size, SUITE_NAME=f"{table}_{layer.lower()}",
    )
    store.ledger.record(seen, OUTCOMES[layer][1])
    return EmptyBatch(layer, batch_id)
