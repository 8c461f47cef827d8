"""Writing rows back out to files."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.session import delete_path, scratch_dir
from sluiceway.sources.listing import list_files


PROBE_ROWS = 200_000
HEADROOM = 0.95  # files are planned to reach this share of the limit
TRIES = 4


def unload_parquet(rows: DataFrame, path: str, max_rows_per_file: int | None = None, max_bytes_per_file: int | None = None) -> None:
    """Parquet files of limited size; the writing tasks stay parallel.

    For a limit in bytes a sample is written first to learn the bytes of a row as Parquet stores it; the rows are
    then dealt evenly to as many files as that asks for.  If a file still comes out too large, as when rows
    differ much, they are dealt to more files.
    """
    if max_bytes_per_file:
        _unload_by_bytes(rows, path, max_bytes_per_file)
        return
    writer = rows.write
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", max_rows_per_file)
    writer.parquet(path)


def _unload_by_bytes(rows: DataFrame, path: str, limit: int) -> None:
    spark, count = rows.sparkSession, rows.count()
    probe = scratch_dir(spark, "probe")
    share = min(1.0, PROBE_ROWS / max(count, 1))
    # Gathered after the sampling: the tasks that read stay parallel, one task gets the sampled rows only.
    rows.sample(share, 1).repartition(1).write.parquet(probe)
    size, _ = _file_sizes(rows, probe)
    delete_path(spark, probe)
    most = max(count, 1)  # a file per row; more would be empty
    files = min(max(1, ceil(size / share / (limit * HEADROOM))), most)
    for _ in range(TRIES):
        rows.repartition(files).write.mode("overwrite").parquet(path)
        _, largest = _file_sizes(rows, path)
        if largest <= limit:
            return
        if files == most:
            break
        files = min(ceil(files * largest / (limit * HEADROOM)), most)
    raise ValueError(f"files of {largest} bytes at {path}: rows are too large for {limit}")


def _file_sizes(rows: DataFrame, path: str) -> tuple[int, int]:
    """Bytes of all Parquet files below a folder, and of the largest."""
    total = list_files(rows.sparkSession, path, "*.parquet").agg(F.sum("length"), F.max("length")).first()
    return total[0] or 0, total[1] or 0


def unload_csv(rows: DataFrame, path: str, single_file: bool = False) -> None:
    """Delimited files with a header.  One file means one writing task: for small extracts."""
    out = rows.coalesce(1) if single_file else rows
    out.write.option("header", "true").option("escape", '"').csv(path)
