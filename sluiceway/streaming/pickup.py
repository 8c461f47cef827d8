"""Files that land in a folder, loaded into the mirror as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluiceway.sources.listing import log_name, not_loaded
from sluiceway.sources.loading import load_csv, load_parquet
from sluiceway.sources.tables import PartTable

LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
LOADERS = {"parquet": load_parquet, "csv": load_csv}


def pick_up(
    spark: SparkSession,
    landing: str,
    mirror: PartTable,
    checkpoint: str,
    file_format: str = "parquet",
    prefix: str = "stream",
    files_per_batch: int = 1000,
    context: dict | None = None,
    metadata: dict | None = None,
) -> StreamingQuery:
    """Load everything that has landed and stop; the checkpoint remembers what was seen.

    The stream carries file names only.  Each micro-batch becomes one mirror batch named after
    the stream's own id and its epoch, so streams and checkpoints do not share names.  Files the
    mirror's log already knows, as after a failure between loading and checkpointing, are not loaded again.
    """
    names = (
        spark.readStream.format("binaryFile")
        .schema(LISTING_SCHEMA)
        .option("pathGlobFilter", f"*.{file_format}")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path")
    )

    def load(arrived: DataFrame, epoch: int) -> None:
        session = arrived.sparkSession
        known = mirror.items().select(F.col("item").alias("file"))
        fresh = not_loaded(arrived.withColumn("file", log_name(F.col("path"), landing)), known)
        files = sorted(r.path for r in fresh.select("path").collect())  # at most files_per_batch
        stream = (session.sparkContext.getLocalProperty("sql.streaming.queryId") or "").replace("-", "")[:12]
        run = {**(context or {}), "BATCH_ID": f"{prefix}-{stream}-{epoch}"}
        LOADERS[file_format](session, mirror, files, run, metadata, base=landing)

    return (
        names.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
