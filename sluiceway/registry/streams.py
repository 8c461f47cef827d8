"""The streaming wrappers, run to the end of the available input."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.plans import transactions as tx
from sluiceway.registry import base as b
from sluiceway.registry.base import Query
from sluiceway.session import scoped_conf, scratch_dir
from sluiceway.sources.listing import list_files
from sluiceway.sources.mirror import open_mirror
from sluiceway.sources.unload import unload_parquet
from sluiceway.operators.audit import AuditLog
from sluiceway.streaming.gates import DISK_STATE, gate_stream, profile_stream, repeats_in_stream, unique_within
from sluiceway.streaming.pickup import pick_up


_FILE_ROWS, _FILES_PER_TRIGGER = 20_000, 8
_MOST_TRIGGERS, _MOST_FILES = 8, 256


def _as_stream(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """The rows as files, read back as a stream of several files per trigger.

    Every micro-batch has a cost of its own and meets all keys before it, so larger inputs come in larger micro-batches of larger
    files, not in more of them.
    """
    path = scratch_dir(spark, label)
    unload_parquet(rows, path, max(_FILE_ROWS, ceil(rows.count() / _MOST_FILES)))
    files = list_files(spark, path, "*.parquet").count()
    per_trigger = max(_FILES_PER_TRIGGER, ceil(files / _MOST_TRIGGERS))
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def _pickup(spark: SparkSession, sf: str) -> DataFrame:
    """Two arrivals picked up by two runs of one stream; a third run finds nothing."""
    landing, mirror = scratch_dir(spark, "landing"), open_mirror(spark, scratch_dir(spark, "mirror"))
    checkpoint = scratch_dir(spark, "progress")
    rows = b.txn_raw(spark, sf)
    late = F.col("_LOADED_AT") >= "1999-01-01"
    for name, part in [("first", rows.where(~late)), ("second", rows.where(late)), (None, None)]:
        if name:
            unload_parquet(part.select(*tx.KEYS), f"{landing}/{name}")
        pick_up(spark, landing, mirror, checkpoint).awaitTermination()
    keys = tx.mirror_keys(mirror.read())
    return keys.select(*tx.KEYS, F.substring_index("_FILENAME", "/", 1).alias("folder"),
                       F.regexp_replace("_BATCH_ID", "-[0-9a-f]{12}-", "-").alias("_BATCH_ID"))


PICKUP_SQL = f"""WITH {b.RAW} SELECT {', '.join(tx.KEYS)},
  CASE WHEN _LOADED_AT >= TIMESTAMP '1999-01-01 00:00:00' THEN 'second' ELSE 'first' END AS folder,
  CASE WHEN _LOADED_AT >= TIMESTAMP '1999-01-01 00:00:00' THEN 'stream-1' ELSE 'stream-0' END AS _BATCH_ID FROM txn_raw"""


def _stream_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Gate metrics of every micro-batch, added up: they are counts."""
    rows = _as_stream(spark, b.txn_dirty(spark, sf).drop("k"), "arrivals")
    path = scratch_dir(spark, "metrics")
    profile_stream(rows, tx.mirror_suite(), ["_BATCH_ID"], path, scratch_dir(spark, "progress")).awaitTermination()
    measured = spark.read.parquet(path).drop("epoch")
    names = [c for c in measured.columns if c != "_BATCH_ID"]
    return measured.groupBy("_BATCH_ID").agg(*[F.sum(n).alias(n) for n in names])


def _stream_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Line-item keys kept once; the bound covers all ship dates, so the result is exact."""
    rows = b.txn_multi(spark, sf).select("TXN_ID", F.col("_LOADED_AT").cast("timestamp").alias("at"))
    once = unique_within(_as_stream(spark, rows, "arrivals"), ["TXN_ID"], "at", "36500 days")
    path = scratch_dir(spark, "unique")
    with scoped_conf(spark, DISK_STATE):
        stream = once.select("TXN_ID").writeStream.format("parquet").option("path", path).option(
            "checkpointLocation", scratch_dir(spark, "progress")
        ).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.read.parquet(path)


def _stream_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose key came before: in a known table, an earlier micro-batch or the same one."""
    rows = b.txn_multi(spark, sf).select("TXN_ID", "_BATCH_ID")
    known = rows.where("_BATCH_ID < 'B1996'")
    path = scratch_dir(spark, "repeats")
    arriving = _as_stream(spark, rows.where("_BATCH_ID >= 'B1996'"), "arrivals")
    keys, progress = scratch_dir(spark, "keys"), scratch_dir(spark, "progress")
    repeats_in_stream(arriving, "TXN_ID", keys, path, progress, known).awaitTermination()
    return spark.read.parquet(path).agg(F.sum("repeats").alias("repeats"))


def _stream_verdicts(spark: SparkSession, sf: str) -> DataFrame:
    """All rows as one micro-batch: a verdict for each batch and check, and the audit row of the epoch."""
    rows = b.txn_dirty(spark, sf).drop("k")
    source = scratch_dir(spark, "arrivals")
    unload_parquet(rows, source, 10_000_000)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    log, path = AuditLog(spark, scratch_dir(spark, "audit")), scratch_dir(spark, "verdicts")
    gate_stream(
        stream, tx.mirror_suite(), "TXN_ID", ["_BATCH_ID"], log, path, scratch_dir(spark, "progress"), "DUP_TXN_ID_IN_BATCH", False
    ).awaitTermination()
    judged = spark.read.parquet(path).select("_BATCH_ID", "metric", "value", "passed")
    logged = log.table("TDQ_RESULTS").select(
        "BATCH_ID", F.lit("logged").alias("metric"), F.col("ROW_COUNT").cast("double").alias("value"), "PASSED"
    )
    return judged.unionAll(logged)


_GATE1 = "SELECT * EXCLUDE (DUP_TXN_ID_IN_BATCH) FROM gate1"


def _gate_sql() -> str:
    from sluiceway.registry.checks import GATE1_SQL

    return f"WITH {b.DIRTY}, {GATE1_SQL} {_GATE1}"


def _verdict_sql() -> str:
    from sluiceway.registry.checks import GATE1_SQL, VERDICT_SQL

    return f"""WITH {b.DIRTY}, {GATE1_SQL}, {VERDICT_SQL} SELECT _BATCH_ID, metric, value, passed FROM verdict
    UNION ALL SELECT 'epoch-0', 'logged', CAST(count(*) AS DOUBLE), FALSE FROM txn_dirty"""


QUERIES = {
    "stream_pickup": Query(_pickup, PICKUP_SQL),
    "stream_gate": Query(_stream_gate, _gate_sql()),
    "stream_unique_keys": Query(_stream_unique, f"WITH {b.MULTI} SELECT DISTINCT TXN_ID FROM txn_multi"),
    "stream_repeats": Query(
        _stream_repeats,
        f"""WITH {b.MULTI}, k AS (SELECT DISTINCT TXN_ID FROM txn_multi WHERE _BATCH_ID < 'B1996'),
        a AS (SELECT TXN_ID FROM txn_multi WHERE _BATCH_ID >= 'B1996')
        SELECT count(*) - (SELECT count(DISTINCT TXN_ID) FROM a WHERE TXN_ID NOT IN (SELECT TXN_ID FROM k)) AS repeats FROM a""",
    ),
    "stream_verdicts": Query(_stream_verdicts, _verdict_sql()),
}
