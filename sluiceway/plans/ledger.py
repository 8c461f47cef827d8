"""What became of every delivery, so that each run can finish what earlier ones left undone.

A delivery is one load under a batch id, named (batch, version).  It shows in the mirror's log as soon as it is
loaded; every later step is recorded here for just the versions that it saw.  A second delivery under
a used batch id therefore starts from the beginning, whatever became of the first.

    loaded -> passed -> staged -> verified -> served
          \\-> failed         \\-> rejected

`failed` and `rejected` wait for somebody to call the gate again; all other states before `served` are taken up
by the next run.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.audit import utc_now
from sluiceway.sources.rowlog import RowLog

LEDGER_SCHEMA = "batch string, version string, state string, at timestamp_ntz"
LOADED, PASSED, FAILED, STAGED, VERIFIED, REJECTED, SERVED = (
    "loaded", "passed", "failed", "staged", "verified", "rejected", "served",
)
ORDER = [LOADED, FAILED, PASSED, STAGED, REJECTED, VERIFIED, SERVED]
# The states from which a delivery may come to a state; from any other the step had no say.
FROM = {
    PASSED: {LOADED, FAILED},
    FAILED: {LOADED, PASSED},
    STAGED: {PASSED},
    VERIFIED: {STAGED, REJECTED},
    REJECTED: {STAGED, VERIFIED},
    SERVED: {VERIFIED, REJECTED},
}

Delivery = tuple[str, str]


class Ledger:
    """The recorded steps below `path`; the latest one of a delivery is its state."""

    _read: dict[str, tuple[tuple[str, ...], dict[Delivery, str]]] = {}  # per path: content read last, and what it was read from

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.log = spark, RowLog(spark, path, LEDGER_SCHEMA)

    def latest(self, rows: DataFrame) -> DataFrame:
        """One row per delivery: its latest step; of one moment, the furthest."""
        place = F.array_position(F.array(*map(F.lit, ORDER)), F.col("state"))
        last = F.max_by(F.struct("state", "at"), F.struct("at", place)).alias("last")
        return rows.groupBy("batch", "version").agg(last).select("batch", "version", "last.*")

    def states(self) -> dict[Delivery, str]:
        """State of every delivery that has one; an entry per delivery."""
        now = self.log.state()
        known = Ledger._read.get(self.log.path)
        if known is None or known[0] != now:
            rows = self.latest(self.log.read()).collect()
            known = now, {(r.batch, r.version): r.state for r in rows}
            Ledger._read[self.log.path] = known
        return dict(known[1])

    def record(self, deliveries: Iterable[Delivery], state: str) -> list[Delivery]:
        """Bring deliveries to a state, where that is a step from the one they are in; returns those that moved."""
        states = self.states()
        moved = [d for d in dict.fromkeys(deliveries) if states.get(d, LOADED) in FROM[state]]
        if moved:
            at = utc_now()
            self.log.append(self.spark.createDataFrame([(*d, state, at) for d in moved], LEDGER_SCHEMA))
        return moved

    def among(self, loaded: Iterable[Delivery], *states: str) -> list[Delivery]:
        """Those of the loaded deliveries that are in one of the states."""
        known = self.states()
        return [d for d in loaded if known.get(d, LOADED) in states]

    def compact(self) -> None:
        """Keep the latest step of each delivery."""
        self.log.rewrite(lambda rows: self.latest(rows).select("batch", "version", "state", "at"))
