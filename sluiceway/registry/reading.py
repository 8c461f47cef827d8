"""Files read by their exact names, rows by their numbers, numbers by their digits, files by their size in bytes."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluiceway.functions.payload import value_of
from sluiceway.registry import base as b
from sluiceway.registry.base import Query
from sluiceway.session import scoped_conf, scratch_dir
from sluiceway.sources.listing import list_files, pending_files
from sluiceway.sources.loading import load_csv, load_parquet, read_csv_inferred
from sluiceway.sources.mirror import open_mirror
from sluiceway.sources.unload import unload_csv, unload_parquet

# Names that a reader of patterns would take for others, beside those others.
ODD_NAMES = ["a[1]", "a1", "{n}", "n", "x*y", "xzy", "b c", "p%41"]


def _odd_names(spark: SparkSession, sf: str) -> DataFrame:
    """Orders dealt to oddly named folders; two loads of each kind, of which the second takes what is pending."""
    o = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("K"), F.col("o_totalprice").cast("decimal(18,2)").alias("V"))
    found = []
    for kind, unload, load in (("csv", unload_csv, load_csv), ("parquet", unload_parquet, load_parquet)):
        landing, mirror = f"{scratch_dir(spark, 'landing')} [0-9]", open_mirror(spark, scratch_dir(spark, "mirror"))
        for i, name in enumerate(ODD_NAMES):
            unload(o.where(F.col("K") % len(ODD_NAMES) == i), f"{landing}/{name}")
            if i in (2, len(ODD_NAMES) - 1):
                load(spark, mirror, pending_files(spark, landing, mirror, f"*.{kind}"), base=landing)
        rows = mirror.read().select(F.substring_index("_FILENAME", "/", 1).alias("folder"), value_of("K", "bigint").alias("k"))
        found.append(rows.groupBy("folder").agg(F.count("*").alias("rows"), F.sum("k").alias("keys")).withColumn("kind", F.lit(kind)))
    return found[0].unionByName(found[1])


_NAMES = ", ".join(f"({i}, '{name}')" for i, name in enumerate(ODD_NAMES))
ODD_SQL = f"""SELECT kind, folder, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
  JOIN (VALUES {_NAMES}) n(i, folder) ON o_orderkey % {len(ODD_NAMES)} = i, (VALUES ('csv'), ('parquet')) k(kind) GROUP BY ALL"""


_LEAST_BLOCK, _MOST_BLOCKS = 16 << 10, 512


def _block_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the blocks in which to read some files: small, so that files have many, but no more tasks than that takes."""
    total = list_files(spark, folder, "*.csv").agg(F.sum("length")).first()[0] or 0
    return max(_LEAST_BLOCK, ceil(total / _MOST_BLOCKS))


def _row_of_number(spark: SparkSession, sf: str) -> DataFrame:
    """Every key with the distance of its row number from its place in the file, whose rows are sorted by key; files of many blocks."""
    o = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("K"), F.col("o_orderpriority").alias("P"))
    landing, mirror = scratch_dir(spark, "landing"), open_mirror(spark, scratch_dir(spark, "mirror"))
    unload_csv(o.repartitionByRange(4, "K").sortWithinPartitions("K"), landing)
    with scoped_conf(spark, {"spark.sql.files.maxPartitionBytes": str(_block_bytes(spark, landing))}):
        load_csv(spark, mirror, pending_files(spark, landing, mirror, "*.csv"), base=landing)
        rows = mirror.read().select("_FILENAME", "_FILE_ROW_NUM", value_of("K", "bigint").alias("k"))
        place = F.row_number().over(Window.partitionBy("_FILENAME").orderBy("k"))
        return rows.select("k", (F.col("_FILE_ROW_NUM") - place).alias("off"))


def _wide_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Types inferred for columns of ever wider numbers, and what their values add up to."""
    key = F.col("o_orderkey")
    o = b.table(spark, sf, "orders").select(
        (F.lit(9223372036854775806) - key).cast("string").alias("LARGE"),
        F.concat(F.lit("123456789012345"), F.lpad(key.cast("string"), 12, "0")).alias("WIDER"),
        F.concat(F.lit("9" * 30), F.lpad(key.cast("string"), 12, "0")).alias("WIDEST"),
        F.concat(F.lit("0."), key.cast("string")).alias("BROKEN"),
    )
    path = scratch_dir(spark, "wide")
    unload_csv(o, path)
    back = read_csv_inferred(spark, [r.path for r in list_files(spark, path, "*.csv").select("path").collect()])
    kinds = dict(back.dtypes)
    totals = [
        F.sum(F.lit(9223372036854775806).cast("decimal(38,0)") - F.col("LARGE")),
        F.sum(F.col("WIDER") - F.lit("123456789012345000000000000").cast("decimal(38,0)")),
        F.sum(F.substring("WIDEST", 31, 12).cast("bigint")),
        F.sum(F.substring(F.col("BROKEN").cast("string"), 3, 20).isNotNull().cast("int")),
    ]
    row = back.agg(*[t.cast("bigint").alias(n) for n, t in zip(kinds, totals)])
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind"), F.col(n).alias("total")) for n, k in kinds.items()])))


WIDE_SQL = """SELECT name, kind, CAST(sum(CASE name WHEN 'BROKEN' THEN 1 ELSE o_orderkey END) AS BIGINT) AS total FROM orders,
  (VALUES ('LARGE', 'bigint'), ('WIDER', 'decimal(38,0)'), ('WIDEST', 'string'), ('BROKEN', 'double')) v(name, kind) GROUP BY ALL"""

LIMIT_BYTES = 64 << 10


def _bytes_limited(spark: SparkSession, sf: str) -> DataFrame:
    """Line items unloaded to files of at most so many bytes: whether all rows are there, and whether a file is too large or far too small."""
    rows, path = b.table(spark, sf, "lineitem"), scratch_dir(spark, "unloaded")
    unload_parquet(rows, path, max_bytes_per_file=LIMIT_BYTES)
    sizes = list_files(spark, path, "*.parquet").agg(F.min("length").alias("least"), F.max("length").alias("most"))
    back = spark.read.parquet(path).agg(F.count("*").alias("rows"), F.sum("l_orderkey").alias("keys"))
    fits = (F.col("most") <= LIMIT_BYTES) & (F.col("least") >= 0.8 * F.col("most"))
    return back.select("rows", "keys", sizes.select(fits).scalar().alias("fits"))


QUERIES = {
    "bytes_limited_unload": Query(
        _bytes_limited, "SELECT count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS keys, TRUE AS fits FROM lineitem"
    ),
    "odd_file_names": Query(_odd_names, ODD_SQL),
    "csv_row_of_number": Query(_row_of_number, "SELECT o_orderkey AS k, CAST(0 AS BIGINT) AS off FROM orders"),
    "csv_wide_numbers": Query(_wide_numbers, WIDE_SQL),
}
