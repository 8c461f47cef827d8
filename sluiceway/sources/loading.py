"""Batch loads: a list of files becomes one batch of the mirror, whole or not at all."""

from __future__ import annotations

import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.functions.payload import object_of
from sluiceway.functions.scalars import ISO_DATE, row_hash, token_to_null
from sluiceway.session import broadcast_bounded, qualified, scoped_conf
from sluiceway.sources.headers import header_groups
from sluiceway.sources.listing import file_path, literal, log_name
from sluiceway.sources.mirror import Lineage, mirror_rows, technical_columns
from sluiceway.sources.tables import PartTable

# The delimited dialect: comma, double quote escaped by doubling, spaces trimmed.
CSV_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "header": "true",
    "mode": "PERMISSIVE",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}
_PATH_BYTES = 1024


@dataclass(frozen=True)
class LoadSummary:
    batch_id: str
    status: str
    headers: int = 0
    files: int = 0
    rows: int = 0
    seconds: float = 0.0


def _start(files: list[str] | None, context: dict | None, metadata: dict | None, loaded_at, user) -> Lineage:
    if files is None:
        raise ValueError("a file list is required")
    context = context or {}
    batch_id = context.get("BATCH_ID") or str(uuid.uuid4())
    return Lineage(batch_id, context, metadata or {}, loaded_at, user)


class FilesDiffer(Exception):
    """Rows came from files that were not given."""


class BatchInUse(Exception):
    """A used batch id was given with files of which only some are in that batch."""


def _finish(
    mirror: PartTable,
    groups: list[DataFrame],
    lineage: Lineage,
    files: list[str],
    base: str | None,
    headers: int,
    began: float,
    verify=None,
) -> LoadSummary:
    """Write all groups in one job, compare the files read with those given, publish, and report what the log now says.

    A used batch id never replaces silently: other files add to the batch, the files of
    earlier deliveries are a retry of these, and anything between is refused.
    """
    spark, batch = mirror.spark, lineage.batch_id
    named = spark.createDataFrame([(f,) for f in qualified(spark, files)], "path string").select(log_name(F.col("path"), base).alias("item"))
    given = {r.item for r in named.collect()}
    earlier: dict[str, set[str]] = {}
    if batch in mirror.live_parts():
        for r in mirror.items().where(F.col("part") == batch).collect():
            earlier.setdefault(r.version, set()).add(r.item)
    same = [version for version, items in earlier.items() if items & given]
    if same and set().union(*(earlier[v] for v in same)) != given:
        raise BatchInUse(f"batch {batch} already holds some of these files, but not just these")
    version = mirror.write(reduce(DataFrame.unionByName, groups))
    if verify:
        verify()
    logged = named.distinct().select(F.lit(batch).alias("part"), F.lit(version).alias("version"), "item")

    def only_given(entries: DataFrame) -> None:
        strays = [r.item for r in entries.join(logged, "item", "left_anti").select("item").limit(3).collect()]
        if strays:
            raise FilesDiffer(f"rows were read from files that were not given: {strays}")

    mirror.publish([version], hide=[(batch, v) for v in same], op="add", given=logged, check=only_given)
    rows = mirror.items().where(F.col("version") == version).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    return LoadSummary(batch, "LOADED", headers, len(given), rows, time.time() - began)


# ---- Parquet -------------------------------------------------------------


def load_parquet(
    spark: SparkSession,
    mirror: PartTable,
    files: list[str] | None,
    context: dict | None = None,
    metadata: dict | None = None,
    base: str | None = None,
    loaded_at=None,
    user: str | None = None,
) -> LoadSummary:
    """Load Parquet files as one batch; keys are the files' own column names."""
    began = time.time()
    lineage = _start(files, context, metadata, loaded_at, user)
    if not files:
        return LoadSummary(lineage.batch_id, "EMPTY")
    groups = [parquet_payload(spark, g, lineage, base) for g in compatible_groups(spark, files)]
    return _finish(mirror, groups, lineage, files, base, 0, began)


def parquet_payload(spark: SparkSession, files: list[str], lineage: Lineage, base: str | None) -> DataFrame:
    # A file that cannot be read must fail the batch, whatever the session allows.
    source = spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "false").parquet(*map(literal, files))
    named = {n: F.col(f"`{n}`") for n in source.columns}
    key = lineage.business_key
    technical = technical_columns(
        lineage,
        log_name(file_path(), base),
        F.col("_metadata.row_index") + 1,
        F.lit(None),
        named.get(key) if key else None,
        row_hash(named),
    )
    return mirror_rows(source, object_of(named), technical)


def compatible_groups(spark: SparkSession, files: list[str]) -> list[list[str]]:
    """One group if the files' schemas merge by name, else one group per footer schema."""
    try:
        spark.read.option("mergeSchema", "true").parquet(*map(literal, files))
        return [files]
    except Exception as conflict:  # raised by the footer job as an untyped error
        if "CANNOT_MERGE_SCHEMAS" not in str(conflict):
            raise
    # Footers only: no row is read here, and only batches with a conflict get this far.
    with ThreadPoolExecutor(16) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(literal(f)).schema.simpleString(), files))
    groups: dict[str, list[str]] = {}
    for file, schema in zip(files, schemas):
        groups.setdefault(schema, []).append(file)
    return list(groups.values())


# ---- delimited text ------------------------------------------------------


def load_csv(
    spark: SparkSession,
    mirror: PartTable,
    files: list[str] | None,
    context: dict | None = None,
    metadata: dict | None = None,
    base: str | None = None,
    loaded_at=None,
    user: str | None = None,
    row_numbers: bool = True,
    multi_line: bool = False,
) -> LoadSummary:
    """Load delimited files as one batch; each file's header names its own keys."""
    began = time.time()
    lineage = _start(files, context, metadata, loaded_at, user)
    if not files:
        return LoadSummary(lineage.batch_id, "EMPTY")
    groups = header_groups(spark, files)
    with scoped_conf(spark, _fixed_splits(spark)):
        parts, checks = [], []
        for names, fingerprint, members in groups:
            rows = read_csv_fields(spark, members, len(names), multi_line)
            if row_numbers:
                rows, observed, expected = number_rows(rows)
                checks.append((observed, expected))
            else:
                rows = rows.withColumn("row_number", F.lit(None).cast("bigint"))
            parts.append(csv_payload(rows, names, fingerprint, lineage, base))
        return _finish(mirror, parts, lineage, files, base, len(groups), began, lambda: _verify(checks))


def _verify(checks: list[tuple[Observation, int]]) -> None:
    for observed, expected in checks:
        if (observed.get["total"] or 0) != expected:
            raise RuntimeError("row numbers do not add up: files changed while they were read")


def read_csv_fields(spark: SparkSession, files: list[str], width: int, multi_line: bool = False) -> DataFrame:
    """Fields by position as text; short rows end in NULL, extra fields are dropped."""
    schema = StructType([StructField(f"f{i}", StringType()) for i in range(width)])
    rows = spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=str(multi_line).lower()).csv([literal(f) for f in files])
    return rows.select(
        *[token_to_null(F.col(n)).alias(n) for n in schema.names],
        file_path().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )


def _fixed_splits(spark: SparkSession) -> dict[str, str]:
    """Pin how files are cut, so that the counting and the loading scan agree."""
    return {"spark.sql.files.minPartitionNum": str(spark.sparkContext.defaultParallelism)}


def number_rows(rows: DataFrame) -> tuple[DataFrame, Observation, int]:
    """Number rows within their file, from 1, without shuffling them.

    A file is read in blocks, each by one task and in order.  Counting rows per
    block gives the number of rows before it; the position inside a block is the
    distance to the block's first id.  Only the per-block counts are moved, so a
    file that holds most of the data is numbered by as many tasks as it has blocks.
    The observed sum of numbers is compared with n(n+1)/2 per file before publishing.
    """
    blocks = rows.groupBy("file", "block").agg(F.count(F.lit(1)).alias("total"), F.min("id").alias("first_id"))
    counted = [(r.file, r.block, r.total, r.first_id) for r in blocks.collect()]
    per_file: dict[str, int] = {}
    offsets = []
    for file, block, n, first_id in sorted(counted):
        offsets.append((file, block, first_id, per_file.get(file, 0)))
        per_file[file] = per_file.get(file, 0) + n
    spark = rows.sparkSession
    table = spark.createDataFrame(offsets, "file string, block bigint, first_id bigint, before bigint")
    table = broadcast_bounded(table, len(offsets), _PATH_BYTES)
    observed = Observation()
    numbered = (
        rows.join(table, ["file", "block"], "left")
        .withColumn("row_number", F.col("id") - F.col("first_id") + F.col("before") + 1)
        .drop("first_id", "before")
        .observe(observed, F.sum(F.col("row_number").cast("decimal(38,0)")).alias("total"))
    )
    return numbered, observed, sum(n * (n + 1) // 2 for n in per_file.values())


def csv_payload(rows: DataFrame, names: list[str], fingerprint: str, lineage: Lineage, base: str | None) -> DataFrame:
    named: dict[str, Column] = {name: F.col(f"f{i}") for i, name in enumerate(names)}
    key = lineage.business_key
    technical = technical_columns(
        lineage,
        log_name(F.col("file"), base),
        F.col("row_number"),
        F.lit(fingerprint),
        named.get(key) if key else None,
        row_hash(named),
    )
    return mirror_rows(rows, object_of(named), technical)


# From the narrowest on: the form a text must have, and the type it then gets.  Whole numbers that no integer type
# holds stay text rather than lose digits.
_WHOLE = r"^[+-]?[0-9]+\z"
_FORMS = [
    (_WHOLE, "bigint"),
    (_WHOLE, "decimal(38,0)"),
    (r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z", "double"),
    (ISO_DATE, "date"),
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?\z", "timestamp_ntz"),
    (r"^(?i)(true|false)\z", "boolean"),
]
_EXACT_IN_DOUBLE = 1 << 53


def infer_types(texts: DataFrame) -> dict[str, str]:
    """For each text column the narrowest type that all its values convert to; one pass over all rows.

    A column with whole numbers beyond 2^53 is never a double, which could not tell them apart.
    """
    counts = []
    for i, name in enumerate(texts.columns):
        value = F.col(f"`{name}`")
        counts.append(F.count(value).alias(f"n{i}"))
        wide = F.abs(value.try_cast("decimal(38,0)")) > _EXACT_IN_DOUBLE
        counts.append(F.count_if(value.rlike(_WHOLE) & F.coalesce(wide, F.lit(True))).alias(f"w{i}"))
        for j, (form, kind) in enumerate(_FORMS):
            counts.append(F.count_if(value.rlike(form) & value.try_cast(kind).isNotNull()).alias(f"n{i}_{j}"))
    row = texts.agg(*counts).first()
    found = {}
    for i, name in enumerate(texts.columns):
        fits = [kind for j, (_, kind) in enumerate(_FORMS) if row[f"n{i}"] and row[f"n{i}_{j}"] == row[f"n{i}"]]
        found[name] = next((kind for kind in fits if kind != "double" or not row[f"w{i}"]), "string")
    return found


def read_csv_inferred(spark: SparkSession, files: list[str]) -> DataFrame:
    """Ad-hoc reading: names from each file's header, types from all values; every no-value token is NULL."""
    groups = []
    for names, _, members in header_groups(spark, files):
        fields = read_csv_fields(spark, members, len(names))
        groups.append(fields.select(*[F.col(f"f{i}").alias(n) for i, n in enumerate(names)]))
    texts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), groups)
    kinds = infer_types(texts)
    return texts.select(*[F.col(f"`{n}`").try_cast(kind).alias(n) for n, kind in kinds.items()])
