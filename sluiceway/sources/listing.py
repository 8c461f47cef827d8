"""Landed files as a relation, and which of them are still to be loaded."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.session import scoped_conf
from sluiceway.sources.tables import PartTable


def file_path() -> Column:
    """Path of the file a row comes from, with URL escapes undone."""
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(escaped)


def literal(path: str) -> str:
    """A path under which Spark's readers find just the file or folder of that name.

    Readers take paths for patterns; characters with a meaning there are escaped.
    """
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def relative_to(path: Column, base: str | None) -> Column:
    """Path below `base`, or the whole path if it lies elsewhere."""
    if not base:
        return path
    root = base.rstrip("/") + "/"
    start = F.instr(path, root)
    return F.when(start > 0, F.substr(path, start + len(root))).otherwise(path)


def log_name(path: Column, base: str | None) -> Column:
    """Name under which a file is logged: below `base`, else the whole path; local paths in one spelling."""
    return relative_to(F.regexp_replace(path, "^file:/+", "file:///"), base)


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Directory listing: relative path, full path, size and time.  File content is not read."""
    found = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(literal(folder))
        .select("path", "length", "modificationTime")
    )
    return found.withColumn("file", relative_to(F.col("path"), folder))


def not_loaded(listing: DataFrame, loaded: DataFrame, on: str = "file") -> DataFrame:
    """Listed files that the load log does not know; the log is small, the mirror is not read."""
    return listing.join(loaded.select(on).distinct(), on, "left_anti")


def pending_files(spark: SparkSession, folder: str, table: PartTable, pattern: str = "*") -> list[str]:
    """Full paths of the next batch, empty if there is nothing new."""
    loaded = table.items().select(F.col("item").alias("file"))
    fresh = not_loaded(list_files(spark, folder, pattern), loaded)
    # No byte is read, so tasks need not follow file sizes: as many as there are cores.
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": str(1 << 50)}):
        return sorted(r.path for r in fresh.select("path").collect())
