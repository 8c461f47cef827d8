"""Files in and out: headers, dialect, batch loads, lineage, discovery, stored tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceway.functions import scalars as fn
from sluiceway.functions.payload import value_of
from sluiceway.operators.profile import load_profile
from sluiceway.plans import transactions as tx
from sluiceway.plans.cycle import run_cycle
from sluiceway.plans.store import Store
from sluiceway.registry import base as b
from sluiceway.registry.base import Query
from sluiceway.session import scratch_dir
from sluiceway.sources.headers import describe_headers
from sluiceway.sources.listing import list_files, not_loaded
from sluiceway.sources.loading import load_csv, load_parquet, read_csv_inferred
from sluiceway.sources.mirror import MIRROR_SCHEMA, Lineage, open_mirror, technical_columns
from sluiceway.sources.tables import PartTable
from sluiceway.sources.unload import unload_csv, unload_parquet

LOADED_AT = datetime(2024, 2, 1, 12, 0, 0)
CONTEXT = {"DATA_DOMAIN": "TXN", "CORRECTION_FL": "N", "PROVIDER_NM": "prov", "PROVIDER_FILE_DT": "2024-01-31 00:00:00"}
METADATA = {"JOB_VERSION_NM": "7", "PROVIDER_FILE_ID": 42, "BUSINESS_KEY": "TXN_ID"}


def _files_below(spark: SparkSession, path: str, ending: str) -> list[str]:
    return [r.path for r in list_files(spark, path, f"*.{ending}").select("path").collect()]


# ---- lineage ---------------------------------------------------------------


def _with_lineage(spark: SparkSession, sf: str, key: bool) -> DataFrame:
    rows = b.txn_raw(spark, sf)
    lineage = Lineage("B-1", CONTEXT, METADATA, LOADED_AT, "loader")
    named = {c: F.col(c) for c in tx.KEYS}
    columns = technical_columns(
        lineage, F.col("_FILENAME"), F.col("k") + 1, F.lit("0123456789ab"), F.col("TXN_ID") if key else None,
        fn.row_hash(named),
    )
    return rows.select("k", *columns.values())


def _technical(spark: SparkSession, sf: str) -> DataFrame:
    return b.plain(_with_lineage(spark, sf, True).withColumn("PROVIDER_FILE_ID", F.col("PROVIDER_FILE_ID").cast("bigint")))


_JSON = "'{' || " + " || ',' || ".join(f"""'"{c}":"' || {c} || '"'""" for c in sorted(tx.KEYS)) + " || '}'"
_AT = "'2024-02-01 12:00:00'"
TECHNICAL_SQL = f"""WITH {b.RAW} SELECT k, {_AT} AS _LOADED_AT, _FILENAME, k + 1 AS _FILE_ROW_NUM, 'B-1' AS _BATCH_ID,
  '0123456789ab' AS _SCHEMA_FP, 'TXN' AS DATA_DOMAIN, 'N' AS CORRECTION_FL, k + 1 AS FILE_RECORD_NBR,
  '7' AS JOB_VERSION_NM, CAST(42 AS BIGINT) AS PROVIDER_FILE_ID, '2024-01-31 00:00:00' AS PROVIDER_FILE_DT,
  md5(TXN_ID || '|' || _FILENAME) AS UNIQUE_HASH_ID, 'loader' AS UPDATED_BY_USER_ID, 'prov' AS PROVIDER_NM,
  {_AT} AS CREATED_DTS, _FILENAME AS PROVIDER_FILE_NM, {_AT} AS UPDATED_DTS, 'loader' AS CREATED_BY_USER_ID,
  CAST(NULL AS VARCHAR) AS FILE_CORRECTION_DTS, md5({_JSON}) AS ROW_HASH_ID, CAST(NULL AS VARCHAR) AS ACQ_REPROCESSING_DTM
  FROM txn_raw"""


def _acceptance(spark: SparkSession, sf: str) -> DataFrame:
    return load_profile(_with_lineage(spark, sf, False))


ACCEPTANCE_SQL = f"""WITH {b.RAW} SELECT count(*) AS total_rows, count(DISTINCT md5({_JSON})) AS distinct_row_hash,
  count(DISTINCT md5('|' || _FILENAME)) AS distinct_unique_hash, count(DISTINCT _FILENAME) AS files FROM txn_raw"""


# ---- discovery -------------------------------------------------------------


def _landed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Files named in the orders, and those delivered before 1999 as already loaded."""
    names = b.txn_raw(spark, sf).select(F.col("_FILENAME").alias("file"))
    return names.distinct(), names.where(F.substring("file", 8, 4) < "1999")


def _new_files(spark: SparkSession, sf: str) -> DataFrame:
    return not_loaded(*_landed(spark, sf))


def _new_files_by_year(spark: SparkSession, sf: str) -> DataFrame:
    """File lists per year, as one array each: names only, at most twelve per year."""
    fresh = _new_files(spark, sf).withColumn("year", F.substring("file", 8, 4))
    listed = fresh.groupBy("year").agg(F.array_sort(F.collect_list("file")).alias("names"))
    return listed.select("year", F.size("names").alias("files"), F.array_join("names", ";").alias("names"))


# ---- headers ---------------------------------------------------------------

_VARIANTS = [
    ("TXN_ID,ACCOUNT_ID,AMOUNT", ["TXN_ID", "ACCOUNT_ID", "AMOUNT"], None),
    ("AMOUNT, ACCOUNT_ID ,TXN_ID", ["AMOUNT", "ACCOUNT_ID", "TXN_ID"], None),
    ("TXN_ID,,AMOUNT", ["TXN_ID", "", "AMOUNT"], "empty column name"),
    ("TXN_ID,AMOUNT,TXN_ID", ["TXN_ID", "AMOUNT", "TXN_ID"], "duplicate column name"),
    ("\ufeffTXN_ID,ACCOUNT_ID,AMOUNT", ["TXN_ID", "ACCOUNT_ID", "AMOUNT"], None),
    ('"TXN_ID","AMOUNT, ""net""",ACCOUNT_ID', ["TXN_ID", 'AMOUNT, "net"', "ACCOUNT_ID"], None),
]


def _header_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One header line per customer who ordered, its last column depending on the customer."""
    who = b.table(spark, sf, "orders").select("o_custkey").distinct()
    shape = F.col("o_custkey") % len(_VARIANTS)
    line = reduce(lambda c, i: c.when(shape == i, F.lit(_VARIANTS[i][0])), range(1, len(_VARIANTS)),
                  F.when(shape == 0, F.lit(_VARIANTS[0][0])))
    suffix = F.concat(F.lit(",C"), (F.col("o_custkey") % 50).cast("string"))
    return who.select(F.col("o_custkey").alias("file"), F.concat(line, suffix).alias("line"))


def _header_groups(spark: SparkSession, sf: str) -> DataFrame:
    described = describe_headers(_header_lines(spark, sf))
    return described.groupBy("fingerprint", F.array_join("names", "|").alias("names"), "problem").agg(
        F.count(F.lit(1)).alias("files"), F.min("file").alias("first_file")
    )


def _variant_case(pick) -> str:
    whens = " ".join(f"WHEN {i} THEN {pick(v)}" for i, v in enumerate(_VARIANTS))
    return f"CASE o_custkey % {len(_VARIANTS)} {whens} END"


HEADERS_SQL = f"""WITH who AS (SELECT DISTINCT o_custkey, 'C' || CAST(o_custkey % 50 AS VARCHAR) AS c FROM orders),
n AS (SELECT o_custkey, {_variant_case(lambda v: "'" + '|'.join(v[1]) + "'")} || '|' || c AS names,
  {_variant_case(lambda v: "'" + ','.join(v[1]) + "'")} || ',' || c AS joined,
  {_variant_case(lambda v: "'" + v[2] + "'" if v[2] else 'NULL')} AS problem FROM who)
SELECT substr(md5(joined), 1, 12) AS fingerprint, names, problem, count(*) AS files, min(o_custkey) AS first_file
FROM n GROUP BY ALL"""


def _lines_of_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of every document, split like a header line."""
    lines = b.table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    split = lines.select("doc_id", fn.header_names(F.col("line")).alias("names"))
    return split.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum(F.size("names")).alias("fields"),
        F.sum(F.aggregate("names", F.lit(0), lambda n, x: n + F.length(x))).alias("characters"),
    )


DOCUMENT_LINES_SQL = f"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
f AS (SELECT doc_id, regexp_extract_all(regexp_replace(line, '^' || chr(65279), '') || ',',
  '{fn.FIELD_PATTERN}', 1) AS raw FROM l),
n AS (SELECT doc_id, list_transform(raw, lambda x: trim(replace(regexp_replace(trim(x), '^"|"$', '', 'g'), '""', '"')))
  AS names FROM f)
SELECT doc_id, count(*) AS lines, CAST(sum(len(names)) AS BIGINT) AS fields,
  CAST(sum(coalesce(list_sum(list_transform(names, lambda x: length(x))), 0)) AS BIGINT) AS characters FROM n GROUP BY doc_id"""


# ---- dialect ---------------------------------------------------------------

_TOKENS = [(7, "NULL"), (11, "N/A"), (13, "n/a"), (17, "\\N"), (19, ""), (23, "   "), (29, " NULL ")]


def _null_tokens(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.txn_raw(spark, sf)
    text = F.concat(F.lit("  "), "AMOUNT", F.lit(" "))
    for divisor, token in reversed(_TOKENS):
        text = F.when(F.col("k") % divisor == 0, F.lit(token)).otherwise(text)
    return raw.select("k", fn.blank_to_null(text).alias("amount"))


def _csv_lines(spark: SparkSession, lines: DataFrame, header: str, label: str) -> list[str]:
    """Write ready-made lines under a header, as they are."""
    path = scratch_dir(spark, label)
    # A separator that does not occur keeps the writer from quoting the lines.
    lines.toDF(header).write.option("header", "true").option("sep", "\u0001").csv(path)
    return _files_below(spark, path, "csv")


def _ragged(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.txn_raw(spark, sf)
    k = F.col("k")
    full = F.concat_ws(",", k.cast("string"), "ACCOUNT_ID", "CURRENCY")
    line = F.when(k % 3 == 0, F.concat_ws(",", k.cast("string"), "ACCOUNT_ID")).when(
        k % 3 == 1, F.concat(full, F.lit(",extra,more"))
    )
    files = _csv_lines(spark, raw.select(line.otherwise(full)), "K,ACCOUNT_ID,CURRENCY", "ragged")
    mirror = open_mirror(spark, scratch_dir(spark, "mirror"))
    load_csv(spark, mirror, files, {"BATCH_ID": "ragged"})
    return mirror.read().select(
        value_of("K", "bigint").alias("k"), value_of("ACCOUNT_ID").alias("ACCOUNT_ID"),
        value_of("CURRENCY").alias("CURRENCY"),
    )


# ---- batch loads -----------------------------------------------------------


def _csv_mirror(spark: SparkSession, sf: str) -> PartTable:
    """The defective rows as delimited files in two column orders, loaded as one batch."""
    rows = b.txn_dirty(spark, sf)
    folder = scratch_dir(spark, "landing")
    unload_csv(rows.where("k % 2 = 0").select(*tx.KEYS), f"{folder}/normal")
    unload_csv(rows.where("k % 2 = 1").select(*reversed(tx.KEYS)), f"{folder}/reordered")
    mirror = open_mirror(spark, scratch_dir(spark, "mirror"))
    load_csv(spark, mirror, _files_below(spark, folder, "csv"), {"BATCH_ID": "csv", **CONTEXT}, METADATA, folder,
             LOADED_AT, "loader")
    return mirror


def _csv_load(spark: SparkSession, sf: str) -> DataFrame:
    rows = _csv_mirror(spark, sf).read()
    keys = tx.mirror_keys(rows, "_SCHEMA_FP", "ROW_HASH_ID")
    return b.plain(keys.withColumn("folder", F.substring_index("_FILENAME", "/", 1)).drop("_FILENAME"))


def _fingerprint_sql(columns: list[str]) -> str:
    return f"substr(md5('{','.join(columns)}'), 1, 12)"


_SPARSE_JSON = (
    "'{' || concat_ws(',', "
    + ", ".join(f"""'"{c}":"' || {c} || '"'""" for c in sorted(tx.KEYS))
    + ") || '}'"
)
CSV_SQL = f"""WITH {b.DIRTY} SELECT {', '.join(tx.KEYS)}, {_AT} AS _LOADED_AT, 'csv' AS _BATCH_ID,
  CASE WHEN k % 2 = 0 THEN {_fingerprint_sql(tx.KEYS)} ELSE {_fingerprint_sql(list(reversed(tx.KEYS)))} END AS _SCHEMA_FP,
  md5({_SPARSE_JSON}) AS ROW_HASH_ID, CASE WHEN k % 2 = 0 THEN 'normal' ELSE 'reordered' END AS folder FROM txn_dirty"""


def _row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Row numbers of every loaded file run from 1 to its number of rows."""
    rows = _csv_mirror(spark, sf).read()
    files = rows.groupBy("_FILENAME").agg(
        F.count(F.lit(1)).alias("n"), F.min("_FILE_ROW_NUM").alias("lo"), F.max("_FILE_ROW_NUM").alias("hi"),
        F.count_distinct("FILE_RECORD_NBR").alias("d"),
    )
    good = (F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("d") == F.col("n"))
    return files.agg(F.sum("n").alias("total_rows"), F.count_if(~good).alias("misnumbered_files"))


def _parquet_mirror(spark: SparkSession, sf: str) -> PartTable:
    """Three deliveries in one batch: plain, with an extra column, and with numeric amounts."""
    rows = b.txn_raw(spark, sf)
    folder = scratch_dir(spark, "landing")
    keys = rows.select("k", *tx.KEYS)
    third = F.col("k") % 3
    unload_parquet(keys.where(third == 0).drop("k"), f"{folder}/plain", 5000)
    unload_parquet(keys.where(third == 1).drop("k").withColumn("DESK", F.lit("D1")), f"{folder}/wider", 5000)
    numeric = keys.where(third == 2).drop("k", "INSTRUMENT_ID").withColumn("AMOUNT", F.col("AMOUNT").cast("decimal(18,4)"))
    unload_parquet(numeric, f"{folder}/typed", 5000)
    mirror = open_mirror(spark, scratch_dir(spark, "mirror"))
    load_parquet(spark, mirror, _files_below(spark, folder, "parquet"), {"BATCH_ID": "pq"}, None, folder, LOADED_AT)
    return mirror


def _parquet_load(spark: SparkSession, sf: str) -> DataFrame:
    rows = _parquet_mirror(spark, sf).read().withColumn("DESK", value_of("DESK"))
    typed = tx.typed_rows(tx.mirror_keys(rows, "DESK"), "DESK")
    return b.plain(typed.withColumn("folder", F.substring_index("_FILENAME", "/", 1)).drop("_FILENAME"))


PARQUET_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw')} SELECT TXN_ID, ACCOUNT_ID,
  CASE WHEN t % 3 <> 2 THEN INSTRUMENT_ID END AS INSTRUMENT_ID, CAST(AMOUNT AS DOUBLE) AS AMOUNT, CURRENCY,
  {b.day_text('TXN_DATE')}, {b.day_text('SETTLEMENT_DATE')}, STATUS, {_AT} AS _LOADED_AT, 'pq' AS _BATCH_ID,
  CASE WHEN t % 3 = 1 THEN 'D1' END AS DESK, CASE t % 3 WHEN 0 THEN 'plain' WHEN 1 THEN 'wider' ELSE 'typed' END AS folder
  FROM (SELECT *, CAST(substr(TXN_ID, 5) AS BIGINT) AS t FROM typed) q"""


def _load_log(spark: SparkSession, sf: str) -> DataFrame:
    """What the load log says about the batch, by delivery."""
    items = _parquet_mirror(spark, sf).items()
    folder = F.substring_index("item", "/", 1).alias("folder")
    return items.groupBy("part", folder).agg(F.sum("rows").alias("rows"))


def _inferred(spark: SparkSession, sf: str) -> DataFrame:
    """All columns of the orders, every fifth price a token for no value."""
    path = scratch_dir(spark, "inferred")
    token = F.element_at(F.array(*[F.lit(x) for x in fn.NULL_TOKENS]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    price = F.when(F.col("o_orderkey") % 7 == 0, token).otherwise(F.col("o_totalprice").cast("string"))
    unload_csv(b.table(spark, sf, "orders").withColumn("o_totalprice", price), path)
    return b.plain(read_csv_inferred(spark, _files_below(spark, path, "csv")))


# ---- stored tables ---------------------------------------------------------


def _deleted(spark: SparkSession, sf: str) -> DataFrame:
    table = PartTable(spark, scratch_dir(spark, "staging"), tx.STAGING_SCHEMA, part="_BATCH_ID")
    table.replace(tx.typed_rows(b.txn_dirty(spark, sf)), spread=True)
    table.delete_where(F.col("_FILENAME").like("orders_1997-0%") | (F.col("CURRENCY") == "CHF"))
    return b.plain(table.read())


def _evolved(spark: SparkSession, sf: str) -> DataFrame:
    """A mirror that began with five columns, read and extended with all of them."""
    path = scratch_dir(spark, "mirror")
    rows = b.txn_raw(spark, sf)
    payload = F.to_variant_object(F.struct(*tx.KEYS)).alias("RAW_DATA")
    five = rows.select(payload, "_LOADED_AT", "_FILENAME", F.col("k").alias("_FILE_ROW_NUM"), F.lit("old").alias("_BATCH_ID"))
    old_schema = StructType([f for f in MIRROR_SCHEMA if f.name in five.columns])
    PartTable(spark, path, old_schema, "_BATCH_ID", "_FILENAME").replace(five)
    mirror = open_mirror(spark, path)
    lineage = Lineage("new", CONTEXT, METADATA, LOADED_AT, "loader")
    named = {c: F.col(c) for c in tx.KEYS}
    new = technical_columns(lineage, F.col("_FILENAME"), F.col("k"), F.lit(None), None, fn.row_hash(named))
    mirror.replace(rows.select(payload, *new.values()).select(MIRROR_SCHEMA.names))
    return mirror.read().groupBy("_BATCH_ID").agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count("DATA_DOMAIN").alias("with_domain"),
        F.count("ROW_HASH_ID").alias("with_hash"),
        F.count(value_of("TXN_ID")).alias("with_key"),
    )


def _seeded(spark: SparkSession, sf: str) -> DataFrame:
    """Reference rows inserted twice, the second time into a table that is no longer empty."""
    rows = b.accounts(spark, sf)
    table = PartTable(spark, scratch_dir(spark, "accounts"), rows.schema, part="ACCOUNT_TYPE")
    table.seed(rows)
    table.seed(rows)
    return table.read()


def _page(spark: SparkSession, sf: str) -> DataFrame:
    """One page of an ordered list; the limit is the feature."""
    return b.plain(b.txn_raw(spark, sf).orderBy("TXN_ID").offset(500).limit(200).select("TXN_ID", "AMOUNT", "TXN_DATE"))


# ---- the whole cycle -------------------------------------------------------


def _cycle_store(spark: SparkSession, sf: str) -> Store:
    """Two deliveries through load, three gates, staging and mart."""
    folder = scratch_dir(spark, "landing")
    store = Store(spark, scratch_dir(spark, "store"), b.accounts(spark, sf), b.instruments(spark, sf))
    rows = b.txn_raw(spark, sf)
    later = F.col("_LOADED_AT") >= "1999-01-01"
    for name, part in [("first", rows.where(~later)), ("second", rows.where(later))]:
        unload_parquet(part.select(*tx.KEYS), f"{folder}/{name}")
        result = run_cycle(store, folder, context={"BATCH_ID": name})
        if result.status != "SUCCESS":
            raise RuntimeError(f"cycle stopped: {result.failed}")
    return store


def _cycle(spark: SparkSession, sf: str) -> DataFrame:
    return b.plain(_cycle_store(spark, sf).mart_rows().drop("_LOADED_AT"))


CYCLE_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw')}, named AS (SELECT * REPLACE (CASE WHEN _LOADED_AT >=
  TIMESTAMP '1999-01-01 00:00:00' THEN 'second' ELSE 'first' END AS _BATCH_ID) FROM typed), {b.mart_sql('named')}
SELECT {b.MART_SQL.replace(b.time_text('_LOADED_AT') + ', ', '')} FROM mart"""


QUERIES = {
    "technical_columns": Query(_technical, TECHNICAL_SQL),
    "load_acceptance": Query(_acceptance, ACCEPTANCE_SQL),
    "new_files": Query(
        _new_files, f"WITH {b.RAW} SELECT DISTINCT _FILENAME AS file FROM txn_raw WHERE substr(_FILENAME, 8, 4) >= '1999'"
    ),
    "new_files_by_year": Query(
        _new_files_by_year,
        f"""WITH {b.RAW}, n AS (SELECT DISTINCT _FILENAME AS file FROM txn_raw WHERE substr(_FILENAME, 8, 4) >= '1999')
        SELECT substr(file, 8, 4) AS year, CAST(count(*) AS INTEGER) AS files, string_agg(file, ';' ORDER BY file) AS names
        FROM n GROUP BY 1""",
    ),
    "header_groups": Query(_header_groups, HEADERS_SQL),
    "document_lines": Query(_lines_of_documents, DOCUMENT_LINES_SQL),
    "null_tokens": Query(
        _null_tokens,
        f"WITH {b.RAW} SELECT k, CASE WHEN "
        + " OR ".join(f"k % {d} = 0" for d, _ in _TOKENS)
        + " THEN NULL ELSE AMOUNT END AS amount FROM txn_raw",
    ),
    "ragged_rows": Query(
        _ragged,
        f"WITH {b.RAW} SELECT k, ACCOUNT_ID, CASE WHEN k % 3 = 0 THEN NULL ELSE CURRENCY END AS CURRENCY FROM txn_raw",
    ),
    "csv_batch_load": Query(_csv_load, CSV_SQL),
    "csv_row_numbers": Query(
        _row_numbers, "SELECT count(*) AS total_rows, CAST(0 AS BIGINT) AS misnumbered_files FROM orders"
    ),
    "parquet_batch_load": Query(_parquet_load, PARQUET_SQL),
    "load_summary": Query(
        _load_log,
        """SELECT 'pq' AS part, CASE o_orderkey % 3 WHEN 0 THEN 'plain' WHEN 1 THEN 'wider' ELSE 'typed' END AS folder,
        count(*) AS rows FROM orders GROUP BY ALL""",
    ),
    "csv_inferred": Query(
        _inferred,
        """SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice END AS o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate) FROM orders""",
    ),
    "delete_by_predicate": Query(
        _deleted,
        f"""WITH {b.DIRTY}, {b.typed_sql('txn_dirty')} SELECT {b.STAGED_SQL} FROM typed
        WHERE NOT coalesce(_FILENAME LIKE 'orders_1997-0%' OR CURRENCY = 'CHF', FALSE)""",
    ),
    "evolve_columns": Query(
        _evolved,
        """SELECT 'old' AS _BATCH_ID, count(*) AS total_rows, CAST(0 AS BIGINT) AS with_domain,
          CAST(0 AS BIGINT) AS with_hash, count(*) AS with_key FROM orders
        UNION ALL SELECT 'new', count(*), count(*), count(*), count(*) FROM orders""",
    ),
    "seed_if_empty": Query(
        _seeded,
        f"SELECT 'ACCT-' || {b._pad_sql('c_custkey', 6)} AS ACCOUNT_ID, c_name AS ACCOUNT_NAME, "
        "c_mktsegment AS ACCOUNT_TYPE FROM customer",
    ),
    "page_offset": Query(
        _page, f"WITH {b.RAW} SELECT TXN_ID, AMOUNT, TXN_DATE FROM txn_raw ORDER BY TXN_ID LIMIT 200 OFFSET 500"
    ),
    "cycle_mart": Query(_cycle, CYCLE_SQL),
}
