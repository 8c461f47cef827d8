"""Checks on a stream: the same metrics per micro-batch, and keys that stay unique."""

from __future__ import annotations

import time
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.functions.metrics import Check
from sluiceway.operators.audit import AuditLog
from sluiceway.operators.keys import key_counts
from sluiceway.operators.profile import attach, duplicate_metric, fused_metrics
from sluiceway.operators.verdict import GateFailed, verdicts
from sluiceway.session import delete_path, fits_broadcast, list_names


def profile_stream(
    rows: DataFrame, checks: Sequence[Check], by: Sequence[str], path: str, checkpoint: str
) -> StreamingQuery:
    """Write the metrics of every micro-batch to `path`, one folder per epoch."""

    def measure(arrived: DataFrame, epoch: int) -> None:
        metrics = fused_metrics(arrived, checks, by)
        # One row per group; a repeated epoch overwrites its own folder.
        metrics.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return (
        rows.writeStream.foreachBatch(measure)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# Session settings under which to start a stream whose keys may outgrow the executors' memory: state is kept on local disk, in
# bounded memory, and a micro-batch stores only what it changed.
_ROCKS = "spark.sql.streaming.stateStore.rocksdb"
DISK_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_ROCKS}.changelogCheckpointing.enabled": "true",
    f"{_ROCKS}.boundedMemoryUsage": "true",
}


def unique_within(rows: DataFrame, keys: Sequence[str], event_time: str, bound: str) -> DataFrame:
    """Drop repeats of a key that arrive within `bound`; state older than that is discarded.  Start it under `DISK_STATE`."""
    return rows.withWatermark(event_time, bound).dropDuplicatesWithinWatermark(list(keys))


def gate_stream(
    rows: DataFrame, checks: Sequence[Check], key: str, by: Sequence[str], audit: AuditLog, path: str, checkpoint: str,
    duplicates: str, stop: bool = True, accepted: str | None = None, quarantine: str | None = None,
) -> StreamingQuery:
    """Judge every micro-batch: verdicts per group to `path`, one audit row, and the stream stops on a failure.

    With `quarantine`, the groups that fail go there instead, the others to `accepted`, and the stream goes on: a bad delivery
    does not hold up what comes after it.  A repeated epoch overwrites its own verdicts and rows and is not
    logged again.  The audit row is written before the stop, as for batches.
    """

    def judge_batch(arrived: DataFrame, epoch: int) -> None:
        began, session = time.time(), arrived.sparkSession
        metrics = fused_metrics(arrived, checks, by)
        metrics = attach(metrics, duplicate_metric(arrived, key, duplicates, by), by)
        verdicts(metrics, checks, by).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        judged = session.read.parquet(f"{path}/epoch={epoch}")
        found = judged.groupBy("passed").count().collect()
        total, bad = sum(r["count"] for r in found), sum(r["count"] for r in found if not r["passed"])
        # The names of the failed checks, at most one per check of the suite.
        names = sorted(r.metric for r in judged.where("NOT passed").select("metric").distinct().collect())
        size = judged.where("metric = 'TOTAL_ROWS'").agg(F.coalesce(F.sum("value"), F.lit(0.0))).first()[0]
        if quarantine:
            failed = judged.where("NOT passed").select(*by).distinct()
            same = reduce(and_, [arrived[c].eqNullSafe(failed[c]) for c in by])
            for kind, where in (("left_semi", quarantine), ("left_anti", accepted)):
                if where:
                    arrived.join(failed, same, kind).write.mode("overwrite").parquet(f"{where}/epoch={epoch}")
        if audit.table("TDQ_RESULTS").where(F.col("BATCH_ID") == f"epoch-{epoch}").isEmpty():
            audit.add(
                "TDQ_RESULTS", BATCH_ID=f"epoch-{epoch}", TABLE_NAME="stream", LAYER="ML", CHECK_TYPE="TDQ", PASSED=not bad,
                TOTAL_CHECKS=total, FAILED_COUNT=bad, FAILED_DETAILS=names, ROW_COUNT=int(size),
                EXECUTION_TIME_SECS=time.time() - began, SUITE_NAME="stream_ml",
            )
        if bad and stop and not quarantine:
            raise GateFailed("ML", f"epoch-{epoch}", names)

    return (
        rows.writeStream.foreachBatch(judge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


LOOSE_EPOCHS = 32
_SEED = -1


def _sorted_once(keys: DataFrame, key: str) -> DataFrame:
    """Each key once, dealt and sorted by range: equal keys meet in their range, so dropping repeats takes no shuffle of its own."""
    return keys.repartitionByRange(key).distinct().sortWithinPartitions(key)


class KeyRuns:
    """Keys of a stream: one folder per epoch, and a sorted run that stands for all epochs up to its number.

    A run counts once its entry in `heads` is written, and what it replaces is deleted by the next gathering.
    """

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _epochs(self, session) -> list[int]:
        return sorted(int(n) for n in list_names(session, f"{self.path}/epochs"))

    def _heads(self, session) -> list[int]:
        """Numbers of the finished runs, the newest last; an entry that died half way holds no row."""
        names = list_names(session, f"{self.path}/heads")
        return [int(n) for n in names if not session.read.schema("keys bigint").parquet(f"{self.path}/heads/{n}").isEmpty()]

    def _folder(self, epoch: int) -> str:
        return f"{self.path}/epochs/{epoch + 1:012d}"

    def seed(self, keys: DataFrame) -> None:
        if not list_names(keys.sparkSession, f"{self.path}/epochs") and not list_names(keys.sparkSession, f"{self.path}/heads"):
            self.add(keys, _SEED)

    def add(self, keys: DataFrame, epoch: int) -> DataFrame:
        keys.write.mode("overwrite").parquet(self._folder(epoch))
        return keys.sparkSession.read.parquet(self._folder(epoch))

    def _loose(self, session, epoch: int, run: int | None) -> list[str]:
        return [f"{self.path}/epochs/{e:012d}" for e in self._epochs(session) if e < epoch + 1 and (run is None or e > run)]

    def folders(self, session, epoch: int) -> list[str]:
        """What holds the keys of all epochs before this one."""
        heads = self._heads(session)
        run = heads[-1] if heads else None
        return ([f"{self.path}/runs/{run:012d}"] if heads else []) + self._loose(session, epoch, run)

    def gather(self, session, key: str, epoch: int) -> None:
        heads = self._heads(session)
        run = heads[-1] if heads else None
        loose = self._loose(session, epoch, run)
        if len(loose) < 2:
            return
        held = session.read.schema("keys bigint").parquet(f"{self.path}/heads/{run:012d}").first()["keys"] if heads else 0
        shape = session.read.parquet(loose[0]).select(key).schema
        if len(loose) < LOOSE_EPOCHS and session.read.schema(shape).parquet(*loose).count() < held:
            return
        last = int(loose[-1].rsplit("/", 1)[-1])
        target = f"{self.path}/runs/{last:012d}"
        every = session.read.schema(shape).parquet(*self.folders(session, epoch))
        _sorted_once(every, key).write.mode("overwrite").parquet(target)
        count = session.read.parquet(target).agg(F.count(F.lit(1)).alias("keys"))
        count.write.mode("overwrite").parquet(f"{self.path}/heads/{last:012d}")
        # What the run before this one replaced, and its predecessors.
        for old in heads[:-1]:
            delete_path(session, f"{self.path}/runs/{old:012d}")
            delete_path(session, f"{self.path}/heads/{old:012d}")
        for e in self._epochs(session):
            if heads and e <= heads[-1]:
                delete_path(session, f"{self.path}/epochs/{e:012d}")


def repeats_in_stream(
    rows: DataFrame, key: str, keys_path: str, path: str, checkpoint: str, known: DataFrame | None = None
) -> StreamingQuery:
    """Without a time bound: count per micro-batch the rows whose key came before, in it or in an earlier one.

    Every micro-batch's keys are stored under its epoch, so a repeated epoch replaces itself and is not compared
    with itself.  Stored keys outside the arriving range are skipped in the scan; the arriving keys go
    to the tasks if they are proven small, so history is not shuffled.  `known` seeds the keys.  Epochs are gathered into
    one sorted run whenever they hold as many keys as the run before, or are LOOSE_EPOCHS: a key is rewritten a
    logarithmic number of times, and the number of folders stays bounded.
    """
    state = KeyRuns(keys_path)

    def compare(arrived: DataFrame, epoch: int) -> None:
        session = arrived.sparkSession
        if known is not None:
            state.seed(known.select(key).distinct())
        mine = state.add(key_counts(arrived.where(F.col(key).isNotNull()), key), epoch)
        n, longest, low, high, arrivals = mine.agg(
            F.count(key), F.max(F.octet_length(key)), F.min(key), F.max(key), F.coalesce(F.sum("_n"), F.lit(0))
        ).first()
        again, earlier = mine.select(key).limit(0), state.folders(session, epoch)
        if n and earlier:
            before = session.read.schema(mine.select(key).schema).parquet(*earlier).where(F.col(key).between(low, high))
            arriving = F.broadcast(mine.select(key)) if fits_broadcast(n, longest) else mine.select(key)
            again = before.join(arriving, key, "left_semi").distinct()
        # The first row of a key that came in an earlier batch is a repeat, too.
        repeats = again.agg((F.count(key) + F.lit(arrivals - n)).alias("repeats"))
        repeats.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        # Only epochs that can no longer be repeated are gathered: all before this one.
        state.gather(session, key, epoch)

    return (
        rows.writeStream.foreachBatch(compare)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
