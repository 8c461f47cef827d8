"""Work that must not pile up as tables grow: micro-batches, single tasks, what reaches the driver."""

import os
from math import ceil

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from sluiceway.registry import guards, reading, streams
from sluiceway.sources import unload
from sluiceway.sources.listing import list_files
from sluiceway.streaming import gates as stream_gates


def _batches(stream, checkpoint):
    """Row counts of the micro-batches of a stream."""
    found = []
    stream.writeStream.foreachBatch(lambda rows, epoch: found.append(rows.count())).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()
    return found


def test_larger_streams_come_in_larger_batches(spark, folder):
    rows = spark.range(0, 10_000, 1, 100).select(F.col("id").cast("string").alias("k"))
    found = _batches(streams._as_stream(spark, rows, "arrivals"), f"{folder}/progress")
    assert sum(found) == 10_000 and len(found) <= 8


def test_unique_keys_keep_their_state_on_disk(spark, folder, monkeypatch):
    """The stream runs under the provider that does not hold all keys in memory, and the session's own is put back."""
    days = spark.range(60).select((F.col("id") % 20).alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit("2000-01-01").cast("date").alias("l_shipdate"),
                                  *[F.lit(1).alias(c) for c in ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")])
    days.write.parquet(f"{folder}/lineitem.parquet")
    progress = f"{folder}/scratch"
    monkeypatch.setattr(streams, "scratch_dir", lambda spark, label: f"{progress}/{label}")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert streams._stream_unique(spark, folder).count() == 20
    logged = spark.read.text(f"{progress}/progress/offsets/0").where("value LIKE '%RocksDBStateStoreProvider%'").count()
    assert logged == 1 and spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_probe_of_an_unload_is_read_by_all_tasks(spark, folder, monkeypatch):
    rows, probes = spark.range(0, 8_000, 1, 8).select("id", F.spark_partition_id().alias("task")), []
    monkeypatch.setattr(unload, "delete_path", lambda spark, path: probes.append(path))
    unload.unload_parquet(rows, f"{folder}/u", max_bytes_per_file=20_000)
    assert spark.read.parquet(probes[0]).select("task").distinct().count() == 8
    assert len(os.listdir(f"{folder}/u")) > 1 and spark.read.parquet(f"{folder}/u").count() == 8_000


def test_blocks_of_large_files_are_not_many(spark, folder, monkeypatch):
    spark.range(20_000).coalesce(1).write.csv(f"{folder}/c")
    total = list_files(spark, f"{folder}/c", "*.csv").first()["length"]
    assert reading._block_bytes(spark, f"{folder}/c") == 16 << 10
    monkeypatch.setattr(reading, "_LEAST_BLOCK", 16)
    assert ceil(total / reading._block_bytes(spark, f"{folder}/c")) <= 512


def test_a_year_is_written_by_many_tasks_and_read_as_one_batch(spark, folder, monkeypatch):
    """Years of many, no and few rows: the same number of files each, and a micro-batch per year."""
    monkeypatch.setattr(guards, "_FILE_ROWS", 250)
    sizes = {2001: 1000, 2002: 0, 2003: 3}
    years = [(year,) for year, n in sizes.items() for _ in range(n)]
    rows = spark.createDataFrame(years, "y int").repartition(5)
    stream = guards._by_year(spark, rows, F.col("y"), list(sizes))
    assert _batches(stream, f"{folder}/progress") == list(sizes.values())


def test_gathered_keys_are_shuffled_once(spark):
    """Keys of several epochs, some of them in each: one shuffle deals, drops and sorts, and files of a run do not overlap."""
    keys = spark.range(0, 3_000, 1, 6).select((F.col("id") % 1_000).cast("string").alias("k"))
    run = stream_gates._sorted_once(keys, "k")
    plan = run._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1, plan
    rows = [(r.part, r.k) for r in run.select(F.spark_partition_id().alias("part"), "k").collect()]
    assert [k for _, k in rows] == sorted(str(i) for i in range(1_000)) and rows == sorted(rows)


def test_repeats_of_epochs_are_counted_in_two_passes(spark, folder, monkeypatch):
    """Known, null, empty and gathered epochs: exact repeats, and the arriving keys are read for their bounds and for the join only."""
    monkeypatch.setattr(stream_gates, "LOOSE_EPOCHS", 2)
    arrivals = [["a", "b", "b", None], [], ["b", "c"], [None, None], ["a", "a", "d", "known"], ["d", "e"]]
    for i, keys in enumerate(arrivals):
        spark.createDataFrame([(k,) for k in keys], "k string").coalesce(1).write.parquet(f"{folder}/in/part={i}")
        for name in os.listdir(f"{folder}/in/part={i}"):
            if name.endswith(".parquet"):
                os.utime(f"{folder}/in/part={i}/{name}", (1_000_000 + i, 1_000_000 + i))
    stream = spark.readStream.schema("k string, part int").option("maxFilesPerTrigger", 1).parquet(f"{folder}/in").select("k")
    plans, seen = [], DataFrameWriter.parquet

    def watched(writer, path, *args):
        if "/out/epoch=" in path:
            plans.append(writer._df._jdf.queryExecution().optimizedPlan().toString())
        return seen(writer, path, *args)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    known = spark.createDataFrame([("known",), ("known",), (None,)], "k string")
    stream_gates.repeats_in_stream(stream, "k", f"{folder}/keys", f"{folder}/out", f"{folder}/progress", known).awaitTermination()
    found = [r.repeats for r in spark.read.parquet(f"{folder}/out").orderBy("epoch").collect()]
    assert found == [1, 0, 1, 0, 3, 1]
    assert max(plan.count("Relation") for plan in plans) == 2
