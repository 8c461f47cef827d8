"""Input views shared by the queries, as DataFrames and as SQL text.

The transaction rows are derived from `orders` and `lineitem`, with defects planted
by key so that every check finds something.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from sluiceway.functions.scalars import pad_number


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(rows: DataFrame) -> DataFrame:
    """Dates and timestamps as text, decimals as doubles, so that two engines compare alike."""

    def show(field) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            c = F.substring(c.cast("string"), 1, 19)
        elif isinstance(field.dataType, DecimalType):
            c = c.cast("double")
        return c.alias(field.name)

    return rows.select([show(f) for f in rows.schema])


def day_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {column}"


def time_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


# ---- transactions from orders ---------------------------------------------

ORDERS_AS_OF = "2001-08-02 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def txn_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k, day = F.col("o_orderkey"), F.col("o_orderdate")
    date = day.cast("date")
    priority = F.substring("o_orderpriority", 1, 1)
    currency = F.when(priority == "1", "USD").when(priority == "2", "EUR").when(priority == "3", "GBP")
    status = F.when(k % 10 == 3, "FAILED").when(F.col("o_orderstatus") == "F", "SETTLED")
    return o.select(
        k.alias("k"),
        F.concat(F.lit("TXN-"), pad_number(k, 10)).alias("TXN_ID"),
        F.concat(F.lit("ACCT-"), pad_number(F.col("o_custkey"), 6)).alias("ACCOUNT_ID"),
        F.concat(F.lit("INST-"), pad_number(k % 2000, 6)).alias("INSTRUMENT_ID"),
        F.col("o_totalprice").cast("decimal(18,4)").cast("string").alias("AMOUNT"),
        currency.when(priority == "4", "JPY").otherwise("CHF").alias("CURRENCY"),
        date.cast("string").alias("TXN_DATE"),
        F.date_add(date, 2).cast("string").alias("SETTLEMENT_DATE"),
        status.when(F.col("o_orderstatus") == "O", "PENDING").otherwise("CANCELLED").alias("STATUS"),
        (day + F.expr("INTERVAL 1 DAY")).alias("_LOADED_AT"),
        F.concat(F.lit("orders_"), F.substring(date.cast("string"), 1, 7), F.lit(".csv")).alias("_FILENAME"),
        F.concat(F.lit("B"), F.year(day).cast("string")).alias("_BATCH_ID"),
    )


def _pad_sql(number: str, width: int) -> str:
    text = f"CAST({number} AS VARCHAR)"
    return f"lpad({text}, CAST(greatest({width}, length({text})) AS INTEGER), '0')"


RAW = f"""txn_raw AS (
  SELECT o_orderkey AS k,
    'TXN-' || {_pad_sql('o_orderkey', 10)} AS TXN_ID,
    'ACCT-' || {_pad_sql('o_custkey', 6)} AS ACCOUNT_ID,
    'INST-' || {_pad_sql('o_orderkey % 2000', 6)} AS INSTRUMENT_ID,
    CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR) AS AMOUNT,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'USD' WHEN '2' THEN 'EUR' WHEN '3' THEN 'GBP'
      WHEN '4' THEN 'JPY' ELSE 'CHF' END AS CURRENCY,
    strftime(o_orderdate, '%Y-%m-%d') AS TXN_DATE,
    strftime(CAST(o_orderdate AS DATE) + 2, '%Y-%m-%d') AS SETTLEMENT_DATE,
    CASE WHEN o_orderkey % 10 = 3 THEN 'FAILED' WHEN o_orderstatus = 'F' THEN 'SETTLED'
      WHEN o_orderstatus = 'O' THEN 'PENDING' ELSE 'CANCELLED' END AS STATUS,
    o_orderdate + INTERVAL 1 DAY AS _LOADED_AT,
    'orders_' || strftime(o_orderdate, '%Y-%m') || '.csv' AS _FILENAME,
    'B' || CAST(year(o_orderdate) AS VARCHAR) AS _BATCH_ID
  FROM orders)"""

# Planted defects: (column, divisor of the key, replacement as SQL); the first that applies wins.
DEFECTS = [
    ("TXN_ID", 101, "NULL"),
    ("TXN_ID", 149, _pad_sql("k", 10)),
    ("TXN_ID", 167, f"'TXN-' || {_pad_sql('(k - 1)', 10)}"),
    ("ACCOUNT_ID", 151, "NULL"),
    ("INSTRUMENT_ID", 179, "NULL"),
    ("AMOUNT", 103, "NULL"),
    ("AMOUNT", 107, "'12x'"),
    ("AMOUNT", 109, "'1-2'"),
    ("AMOUNT", 157, "'-5.0'"),
    ("AMOUNT", 163, "'200000000'"),
    ("CURRENCY", 113, "'usd'"),
    ("CURRENCY", 127, "'XXX'"),
    ("TXN_DATE", 137, "'2024/01/05'"),
    ("TXN_DATE", 173, "NULL"),
    ("SETTLEMENT_DATE", 139, "'n.d.'"),
    ("STATUS", 131, "'UNKNOWN'"),
]
_DAMAGED = ["TXN_ID", "ACCOUNT_ID", "INSTRUMENT_ID", "AMOUNT", "CURRENCY", "TXN_DATE", "SETTLEMENT_DATE", "STATUS"]
_UNTOUCHED = ["k", "_LOADED_AT", "_FILENAME", "_BATCH_ID"]


def _damage_sql(column: str) -> str:
    cases = " ".join(f"WHEN k % {d} = 0 THEN {new}" for c, d, new in DEFECTS if c == column)
    return f"CASE {cases} ELSE {column} END AS {column}"


DIRTY = f"""{RAW}, txn_dirty AS (
  SELECT k, {', '.join(_damage_sql(c) for c in _DAMAGED)}, _LOADED_AT, _FILENAME, _BATCH_ID FROM txn_raw)"""


def txn_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = pad_number(F.col("k"), 10)
    before = F.concat(F.lit("TXN-"), pad_number(F.col("k") - 1, 10))
    # Replacements that are not plain texts.
    computed = {("TXN_ID", 149): key, ("TXN_ID", 167): before}

    def damaged(column: str) -> Column:
        new = F.col(column)
        for c, divisor, text in reversed(DEFECTS):
            if c == column:
                value = computed.get((c, divisor), F.lit(None if text == "NULL" else text.strip("'")))
                new = F.when(F.col("k") % divisor == 0, value).otherwise(new)
        return new.alias(column)

    return txn_raw(spark, sf_dir).select("k", *[damaged(c) for c in _DAMAGED], *_UNTOUCHED[1:])


def _day_sql(column: str) -> str:
    return f"CASE WHEN length({column}) = 10 THEN CAST(try_strptime({column}, '%Y-%m-%d') AS DATE) END AS {column}"


def typed_sql(source: str, name: str = "typed") -> str:
    return f"""{name} AS (
  SELECT TXN_ID, ACCOUNT_ID, INSTRUMENT_ID, TRY_CAST(AMOUNT AS DECIMAL(18,4)) AS AMOUNT,
    upper(trim(CURRENCY)) AS CURRENCY, {_day_sql('TXN_DATE')}, {_day_sql('SETTLEMENT_DATE')},
    upper(trim(STATUS)) AS STATUS, _LOADED_AT, _FILENAME, _BATCH_ID
  FROM {source}), {name}_ok AS (
  SELECT * FROM {name} WHERE AMOUNT IS NOT NULL AND TXN_DATE IS NOT NULL AND TXN_ID IS NOT NULL)"""


def latest_sql(source: str, name: str) -> str:
    """One row per TXN_ID, the latest."""
    return f"""{name} AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY TXN_ID ORDER BY _LOADED_AT DESC,
    _FILENAME DESC, ACCOUNT_ID DESC NULLS LAST, INSTRUMENT_ID DESC NULLS LAST, AMOUNT DESC) AS rn FROM {source}) t
  WHERE rn = 1)"""


LATEST_TIES = ["ACCOUNT_ID", "INSTRUMENT_ID", "AMOUNT"]
STAGED_SQL = (
    "TXN_ID, ACCOUNT_ID, INSTRUMENT_ID, CAST(AMOUNT AS DOUBLE) AS AMOUNT, CURRENCY, "
    f"{day_text('TXN_DATE')}, {day_text('SETTLEMENT_DATE')}, STATUS, {time_text('_LOADED_AT')}, _FILENAME, _BATCH_ID"
)


def mart_sql(source: str, name: str = "mart") -> str:
    return f"""{name} AS (
  SELECT TXN_ID, ACCOUNT_ID, INSTRUMENT_ID, AMOUNT, CURRENCY, TXN_DATE, SETTLEMENT_DATE, STATUS,
    CAST(date_trunc('month', TXN_DATE) AS DATE) AS TXN_MONTH, CAST(date_trunc('year', TXN_DATE) AS DATE) AS TXN_YEAR,
    dayofweek(TXN_DATE) AS TXN_DAY_OF_WEEK,
    SUM(AMOUNT) OVER (PARTITION BY ACCOUNT_ID ORDER BY TXN_DATE, TXN_ID
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS RUNNING_POSITION_BY_ACCOUNT,
    _LOADED_AT, _BATCH_ID
  FROM {source})"""


MART_SQL = (
    "TXN_ID, ACCOUNT_ID, INSTRUMENT_ID, CAST(AMOUNT AS DOUBLE) AS AMOUNT, CURRENCY, "
    f"{day_text('TXN_DATE')}, {day_text('SETTLEMENT_DATE')}, STATUS, {day_text('TXN_MONTH')}, {day_text('TXN_YEAR')}, "
    "CAST(TXN_DAY_OF_WEEK AS INTEGER) AS TXN_DAY_OF_WEEK, "
    "CAST(RUNNING_POSITION_BY_ACCOUNT AS DOUBLE) AS RUNNING_POSITION_BY_ACCOUNT, "
    f"{time_text('_LOADED_AT')}, _BATCH_ID"
)


# ---- transactions from lineitem --------------------------------------------


def txn_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that repeat within and across batches."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("TXN_ID"),
        F.concat(F.lit("B"), F.year("l_shipdate").cast("string")).alias("_BATCH_ID"),
        F.col("l_shipdate").alias("_LOADED_AT"),
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
    )


MULTI = """txn_multi AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS TXN_ID,
    'B' || CAST(year(l_shipdate) AS VARCHAR) AS _BATCH_ID, l_shipdate AS _LOADED_AT,
    l_partkey, l_suppkey, l_extendedprice, l_quantity
  FROM lineitem)"""


# ---- audit rows from events -------------------------------------------------


def audit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    layer = F.when(F.col("event_id") % 3 == 0, "ML").when(F.col("event_id") % 3 == 1, "STG").otherwise("SDM")
    return e.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("BATCH_ID"),
        F.concat(F.lit("T_"), F.col("event_type")).alias("TABLE_NAME"),
        layer.alias("LAYER"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("RUN_AT"),
        (F.col("event_type") != "error").alias("PASSED"),
        F.lit(17).cast("bigint").alias("TOTAL_CHECKS"),
        F.when(F.col("event_type") == "error", F.col("event_id") % 17 + 1).otherwise(0).alias("FAILED_COUNT"),
        F.col("event_id").alias("ROW_COUNT"),
        F.col("value").alias("EXECUTION_TIME_SECS"),
        F.concat(F.lit("v2 "), F.col("event_type")).alias("NOTES"),
    )


AUDIT = """audit AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS BATCH_ID, 'T_' || event_type AS TABLE_NAME,
    CASE event_id % 3 WHEN 0 THEN 'ML' WHEN 1 THEN 'STG' ELSE 'SDM' END AS LAYER,
    date_trunc('second', ts) AS RUN_AT, event_type <> 'error' AS PASSED, CAST(17 AS BIGINT) AS TOTAL_CHECKS,
    CASE WHEN event_type = 'error' THEN event_id % 17 + 1 ELSE 0 END AS FAILED_COUNT,
    event_id AS ROW_COUNT, value AS EXECUTION_TIME_SECS, 'v2 ' || event_type AS NOTES
  FROM events)"""


# ---- references --------------------------------------------------------------


def accounts(spark: SparkSession, sf_dir: str, incomplete: bool = False) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("ACCT-"), pad_number(F.col("c_custkey"), 6)).alias("ACCOUNT_ID"),
        F.col("c_name").alias("ACCOUNT_NAME"),
        F.col("c_mktsegment").alias("ACCOUNT_TYPE"),
    )
    return c.where(~F.col("ACCOUNT_ID").rlike("[05]7$")) if incomplete else c


def instruments(spark: SparkSession, sf_dir: str, incomplete: bool = False) -> DataFrame:
    """Instruments that occur in the orders; without the last hundred if `incomplete`."""
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 2000).alias("i")).distinct()
    o = o.where(F.col("i") < 1900) if incomplete else o
    return o.select(F.concat(F.lit("INST-"), pad_number(F.col("i"), 6)).alias("INSTRUMENT_ID"))


REFERENCES = f"""accounts AS (SELECT 'ACCT-' || {_pad_sql('c_custkey', 6)} AS ACCOUNT_ID FROM customer),
instruments AS (SELECT DISTINCT 'INST-' || {_pad_sql('o_orderkey % 2000', 6)} AS INSTRUMENT_ID FROM orders),
accounts_part AS (SELECT * FROM accounts WHERE right(ACCOUNT_ID, 2) NOT IN ('07', '57')),
instruments_part AS (SELECT * FROM instruments WHERE CAST(right(INSTRUMENT_ID, 6) AS INTEGER) < 1900)"""
