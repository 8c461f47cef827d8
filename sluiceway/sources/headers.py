"""Header lines of delimited files: read, check and group them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.scalars import header_fingerprint, header_names, stray_quote
from sluiceway.session import scoped_conf
from sluiceway.sources.listing import file_path, literal

# Files up to this size are read whole, many by one task; of larger ones a task reads the start and stops.
SMALL_FILE_BYTES = 1 << 20
_NEVER = str(1 << 50)
_ONE_FILE_PER_TASK = {
    "spark.sql.files.maxPartitionBytes": _NEVER,
    "spark.sql.files.openCostInBytes": _NEVER,
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
}


class BadHeader(Exception):
    """At least one file of the batch has no usable header."""


def line_scans(spark: SparkSession, files: list[str]) -> list[tuple[dict[str, str], DataFrame]]:
    """First lines as (file, line), in one scan for small and one for large files, each with the settings to run it under.

    Small files are dealt to as many tasks as there are cores, however many files there are; no file is cut.  The
    tasks of the large ones end after the first line.
    """
    sizes = spark.read.format("binaryFile").load([literal(f) for f in files]).select("path", "length")
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": _NEVER}):  # no byte is read here
        big = {_plain(r.path) for r in sizes.where(F.col("length") > SMALL_FILE_BYTES).select("path").collect()}

    # Local, so that they travel to the workers by value: they need not have this package.
    def first_row(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    def first_rows(batches):
        before = None
        for batch in batches:
            names = batch.column(0).to_pylist()
            starts = [i for i, name in enumerate(names) if name != (names[i - 1] if i else before)]
            if starts:
                yield batch.take(starts)
            before = names[-1] if names else before

    each_core = {
        "spark.sql.files.maxPartitionBytes": _NEVER,
        "spark.sql.files.openCostInBytes": str(SMALL_FILE_BYTES),
        "spark.sql.files.minPartitionNum": str(spark.sparkContext.defaultParallelism),
    }
    scans = []
    for is_big, settings, pick in ((False, each_core, first_rows), (True, _ONE_FILE_PER_TASK, first_row)):
        group = [literal(f) for f in files if (_plain(f) in big) == is_big]
        if group:
            lines = spark.read.text(group).select(file_path().alias("file"), F.col("value").alias("line"))
            scans.append((settings, lines.mapInArrow(pick, "file string, line string")))
    return scans


def _plain(path: str) -> str:
    return re.sub("^file:/+", "/", path)


def describe_headers(lines: DataFrame, line: str = "line", max_columns: int | None = None) -> DataFrame:
    """Add `names`, `fingerprint` and `problem` (NULL if the header is usable); no column limit unless given."""
    return (
        lines.withColumn("names", header_names(F.col(line)))
        .withColumn("fingerprint", header_fingerprint(F.col("names")))
        .withColumn("problem", header_problem(F.col("names"), F.col(line), max_columns))
    )


def header_problem(names: Column, line: Column, max_columns: int | None = None) -> Column:
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return (
        F.when(line.isNull() | (F.trim(line) == ""), "no header row")
        .when(quotes % 2 == 1, "unbalanced quote")
        .when(stray_quote(line), "stray quote")
        .when(F.size(names) >= max_columns if max_columns else F.lit(False), "too many columns")
        .when(F.exists(names, lambda n: n == ""), "empty column name")
        .when(F.size(F.array_distinct(names)) != F.size(names), "duplicate column name")
    )


def header_groups(spark: SparkSession, files: list[str], max_columns: int | None = None) -> list[tuple[list[str], str, list[str]]]:
    """(names, fingerprint, files) per distinct header; fails on the first bad file.

    Headers are read, checked and grouped in the tasks: the driver gets a row per distinct header.
    """
    # By names: different name lists can share a fingerprint.
    groups: dict[tuple[str, ...], tuple[list[str], str, list[str]]] = {}
    bad, found = [], 0
    for settings, lines in line_scans(spark, files):
        described = describe_headers(lines, max_columns=max_columns)
        grouped = described.groupBy("names", "fingerprint", "problem").agg(F.sort_array(F.collect_list("file")).alias("files"))
        with scoped_conf(spark, settings):
            rows = grouped.collect()
        for row in rows:
            found += len(row.files)
            if row.problem:
                bad += [f"{file}: {row.problem}: {row.names}" for file in row.files]
            else:
                groups.setdefault(tuple(row.names), (row.names, row.fingerprint, []))[2].extend(row.files)
    if found < len(set(map(_plain, files))):
        raise BadHeader(f"no header row in {len(set(map(_plain, files))) - found} of {len(files)} files")
    if bad:
        raise BadHeader("; ".join(sorted(bad)[:3]) + (f" and {len(bad) - 3} more" if len(bad) > 3 else ""))
    return list(groups.values())
