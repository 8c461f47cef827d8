"""Batch validation and mart building on Spark DataFrames.

Files land in a schema-flexible mirror, pass a suite of checks, become typed
staging rows by keyed upsert, feed a mart with running totals, and leave an
audit trail.  Every step is a DataFrame transformation or one write job.
"""

from sluiceway.operators.verdict import EmptyBatch, GateFailed
from sluiceway.plans.cycle import rebuild_mart, refresh_mart, run_cycle, stage_new_rows
from sluiceway.plans.gates import gate_mart, gate_mirror, gate_staging
from sluiceway.plans.store import Store
from sluiceway.sources.listing import pending_files
from sluiceway.sources.loading import load_csv, load_parquet
from sluiceway.sources.mirror import open_mirror
from sluiceway.streaming.pickup import pick_up

__version__ = "0.1.0"
__all__ = [
    "EmptyBatch", "GateFailed", "Store", "gate_mart", "gate_mirror", "gate_staging", "load_csv", "load_parquet",
    "open_mirror", "pending_files", "pick_up", "rebuild_mart", "refresh_mart", "run_cycle", "stage_new_rows",
]
