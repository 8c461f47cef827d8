"""The same builders on other tables, payload access and the scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions import metrics as m
from sluiceway.functions import scalars as fn
from sluiceway.functions.metrics import Check
from sluiceway.functions.payload import object_of, object_without_nulls, value_of
from sluiceway.operators.profile import attach, duplicate_metric, fused_metrics
from sluiceway.operators.verdict import verdicts
from sluiceway.registry import base as b
from sluiceway.registry.base import Query

KINDS = ["signup", "purchase", "view", "click"]


def event_suite() -> list[Check]:
    value, props = F.col("value"), F.col("props")
    return [
        Check("NULL_USER", "completeness", m.null_count(F.col("user_id"))),
        Check("BAD_KIND", "domain", m.not_in(F.col("event_type"), KINDS)),
        Check("BAD_RANGE_VALUE", "range", m.out_of_range(value, 0, 500)),
        Check("BAD_FMT_PROPS", "column_type",
              m.bad_format(props, props.like("{%}"))),
        Check("BAD_CAST_PROPS", "column_type", m.bad_cast(props, F.try_parse_json(props))),
        Check("TOTAL_ROWS", "volume", m.row_count(), 1, None),
    ]


def _events(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    metrics = fused_metrics(rows, event_suite(), ["day"])
    suite = [*event_suite(), Check("DUP_EVENT", "uniqueness")]
    metrics = attach(metrics, duplicate_metric(rows, "event_id", "DUP_EVENT", ["day"]), ["day"])
    return verdicts(metrics, suite, ["day"]).select("day", "metric", "value", "passed")


EVENTS_SQL = """WITH g AS (SELECT strftime(ts, '%Y-%m-%d') AS day,
  count(*) FILTER (user_id IS NULL) AS NULL_USER,
  count(*) FILTER (event_type NOT IN ('signup','purchase','view','click')) AS BAD_KIND,
  count(*) FILTER (value <= 0 OR value > 500) AS BAD_RANGE_VALUE,
  count(props) - count(*) FILTER (props LIKE '{%}') AS BAD_FMT_PROPS,
  count(*) FILTER (props IS NOT NULL AND NOT json_valid(props)) AS BAD_CAST_PROPS,
  count(*) AS TOTAL_ROWS, count(*) - count(DISTINCT event_id) AS DUP_EVENT FROM events GROUP BY 1)
SELECT day, metric, CAST(n AS DOUBLE) AS value, CASE WHEN metric = 'TOTAL_ROWS' THEN n >= 1 ELSE n = 0 END AS passed
FROM (UNPIVOT g ON COLUMNS(* EXCLUDE (day)) INTO NAME metric VALUE n) u"""


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts: stated length against counted length, languages, repeated texts."""
    rows = b.table(spark, sf, "documents")
    checks = [
        Check("NULL_TEXT", "completeness", m.null_count(F.col("text"))),
        Check("BAD_DERIVED_N_CHARS", "derived_column", m.bad_derived(F.col("n_chars"), F.length("text"))),
        Check("BAD_LANG", "domain", m.not_in(F.col("lang"), ["en", "de"])),
        Check("TOTAL_ROWS", "volume", m.row_count(), 1, None),
    ]
    metrics = fused_metrics(rows, checks, ["source"])
    hashed = rows.select("source", F.md5("text").alias("digest"))
    return attach(metrics, duplicate_metric(hashed, "digest", "DUP_TEXT", ["source"]), ["source"])


def _conversations(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.table(spark, sf, "conversations")
    checks = [
        Check("MISSING_ANY", "schema", m.missing_any([F.col(c) for c in ["conv_id", "turn", "role", "text"]])),
        Check("EMPTY_TEXT", "completeness", F.count_if(F.trim("text") == "")),
        Check("TOTAL_ROWS", "volume", m.row_count(), 1, None),
    ]
    return fused_metrics(rows, checks, ["role"])


def _payload(spark: SparkSession, sf: str) -> DataFrame:
    events = b.table(spark, sf, "events").withColumn("RAW_DATA", F.parse_json("props"))
    named = {"kind": F.col("event_type"), "user": F.when(F.col("user_id") % 2 == 0, F.col("user_id").cast("string"))}
    return events.select(
        "event_id",
        value_of("k", "bigint").alias("k"),
        value_of("absent").alias("absent"),
        F.to_json(object_of(named)).alias("kept"),
        F.to_json(object_without_nulls(named)).alias("dropped"),
    )


PAYLOAD_SQL = """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS absent,
  '{"kind":"' || event_type || '","user":' || CASE WHEN user_id % 2 = 0 THEN '"' || user_id || '"' ELSE 'null' END || '}' AS kept,
  '{"kind":"' || event_type || '"' || CASE WHEN user_id % 2 = 0 THEN ',"user":"' || user_id || '"' ELSE '' END || '}' AS dropped
  FROM events"""


def _scalars(spark: SparkSession, sf: str) -> DataFrame:
    """The scalar functions in one projection."""
    o = b.table(spark, sf, "orders")
    key, day, price = F.col("o_orderkey"), F.col("o_orderdate"), F.col("o_totalprice")
    late = F.timestamp_add("SECOND", F.lit(-90), day)
    return o.select(
        key.alias("k"),
        F.concat("o_orderstatus", F.lit("-"), "o_orderpriority").alias("concat_text"),
        F.concat_ws("|", "o_orderstatus", F.lit(None).cast("string"), "o_orderpriority").alias("concat_ws_text"),
        F.coalesce(F.when(key % 2 == 0, F.col("o_orderstatus")), F.lit("?")).alias("coalesced"),
        F.md5("o_orderpriority").alias("digest"),
        fn.code(F.concat(F.lit(" "), "o_orderpriority", F.lit(" "))).alias("code"),
        F.length("o_orderpriority").alias("len"),
        F.translate("o_orderpriority", "ABCDE-", "").alias("translated"),
        F.replace("o_orderpriority", F.lit("-"), F.lit("::")).alias("replaced"),
        fn.pad_number(key, 8).alias("padded"),
        F.col("o_orderpriority").like("1-%").alias("is_first"),
        F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("shown"),
        F.date_format(F.date_add(day.cast("date"), 30), "yyyy-MM-dd").alias("plus_30"),
        F.date_format(late, "yyyy-MM-dd HH:mm:ss").alias("minus_90s"),
        fn.elapsed("MINUTE", late, day).alias("minutes"),
        fn.elapsed("DAY", day, F.lit(b.ORDERS_AS_OF).cast("timestamp_ntz")).alias("days"),
        F.date_format(fn.month_start(day), "yyyy-MM-dd").alias("month"),
        F.date_format(fn.year_start(day), "yyyy-MM-dd").alias("year"),
        fn.weekday(day).alias("weekday"),
        fn.safe_decimal(F.concat((key % 1000).cast("string"), F.lit(".12345"))).cast("double").alias("decimal_text"),
        F.date_format(fn.strict_date(F.when(key % 3 == 0, "2024-1-5").otherwise("2024-01-05")), "yyyy-MM-dd").alias("strict"),
        price.cast("bigint").alias("whole"),
        (key % 7).alias("modulo"),
        F.abs(F.lit(250000) - price).alias("distance"),
        F.round(price / 1000, 1).alias("rounded"),
        F.greatest(key, F.lit(100)).alias("at_least"),
        F.size(F.array("o_orderstatus", "o_orderpriority")).alias("array_size"),
        F.to_json(F.parse_json(F.concat(F.lit('{"a":'), key.cast("string"), F.lit("}")))).alias("object"),
    )


SCALARS_SQL = f"""SELECT o_orderkey AS k, o_orderstatus || '-' || o_orderpriority AS concat_text,
  concat_ws('|', o_orderstatus, NULL, o_orderpriority) AS concat_ws_text,
  coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END, '?') AS coalesced, md5(o_orderpriority) AS digest,
  upper(trim(' ' || o_orderpriority || ' ')) AS code, CAST(length(o_orderpriority) AS INTEGER) AS len,
  translate(o_orderpriority, 'ABCDE-', '') AS translated, replace(o_orderpriority, '-', '::') AS replaced,
  {b._pad_sql('o_orderkey', 8)} AS padded, o_orderpriority LIKE '1-%' AS is_first,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS shown, strftime(CAST(o_orderdate AS DATE) + 30, '%Y-%m-%d') AS plus_30,
  strftime(o_orderdate - INTERVAL 90 SECOND, '%Y-%m-%d %H:%M:%S') AS minus_90s, CAST(1 AS BIGINT) AS minutes,
  CAST(floor(epoch(TIMESTAMP '{b.ORDERS_AS_OF}' - o_orderdate) / 86400) AS BIGINT) AS days,
  strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month,
  strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year, CAST(dayofweek(o_orderdate) AS INTEGER) AS weekday,
  CAST(CAST((o_orderkey % 1000) || '.12345' AS DECIMAL(18,4)) AS DOUBLE) AS decimal_text,
  CASE WHEN o_orderkey % 3 <> 0 THEN '2024-01-05' END AS strict, CAST(trunc(o_totalprice) AS BIGINT) AS whole,
  o_orderkey % 7 AS modulo, abs(250000 - o_totalprice) AS distance, round(o_totalprice / 1000, 1) AS rounded,
  greatest(o_orderkey, 100) AS at_least, CAST(2 AS INTEGER) AS array_size, '{{"a":' || o_orderkey || '}}' AS object FROM orders"""


QUERIES = {
    "group_checks_events": Query(_events, EVENTS_SQL),
    "group_checks_documents": Query(
        _documents,
        """SELECT source, count(*) FILTER (text IS NULL) AS NULL_TEXT,
        count(*) FILTER (n_chars <> length(text)) AS BAD_DERIVED_N_CHARS,
        count(*) FILTER (lang NOT IN ('en', 'de')) AS BAD_LANG, count(*) AS TOTAL_ROWS,
        count(*) - count(DISTINCT md5(text)) AS DUP_TEXT FROM documents GROUP BY source""",
    ),
    "group_checks_conversations": Query(
        _conversations,
        """SELECT role, count(*) FILTER (conv_id IS NULL OR turn IS NULL OR role IS NULL OR text IS NULL) AS MISSING_ANY,
        count(*) FILTER (trim(text) = '') AS EMPTY_TEXT, count(*) AS TOTAL_ROWS FROM conversations GROUP BY role""",
    ),
    "variant_extract": Query(_payload, PAYLOAD_SQL),
    "scalar_functions": Query(_scalars, SCALARS_SQL),
}
