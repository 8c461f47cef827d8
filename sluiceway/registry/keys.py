"""Duplicates, cross-batch repeats, references, provenance, latest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.functions.metrics import Check, row_count
from sluiceway.operators import keys as k
from sluiceway.operators.profile import attach, fused_metrics
from sluiceway.registry import base as b
from sluiceway.registry.base import Query
from sluiceway.session import broadcast_bounded, fits_broadcast, scratch_dir
from sluiceway.sources.tables import PartTable


def _cross_batch(spark: SparkSession, sf: str) -> DataFrame:
    return k.repeats_across(b.txn_multi(spark, sf), "TXN_ID", "_BATCH_ID")


def _newest_against_history(spark: SparkSession, sf: str) -> DataFrame:
    """The newest batch against all earlier ones, with the size bound measured first."""
    rows = b.txn_multi(spark, sf)
    bounds = fused_metrics(rows, [*k.KeyBounds.metrics("TXN_ID"), Check("n", "", row_count())], ["_BATCH_ID"])
    newest = bounds.orderBy(F.desc("_BATCH_ID")).limit(1).first()
    current = rows.where(F.col("_BATCH_ID") == newest["_BATCH_ID"])
    history = rows.where(F.col("_BATCH_ID") != newest["_BATCH_ID"])
    found = k.key_metrics(current, history, "TXN_ID", k.KeyBounds.of(newest["n"], newest), "duplicates", "repeats")
    return found.withColumn("_BATCH_ID", F.lit(newest["_BATCH_ID"]))


_AGAIN = "1998-06"


def _random_keys(spark: SparkSession, sf: str) -> DataFrame:
    """For every stored year of orders under random ids: its keys that a new batch repeats; filters say which years are read.

    The batch repeats one month and adds an id for each line item.
    """
    orders = b.table(spark, sf, "orders").select(
        F.md5(F.col("o_orderkey").cast("string")).alias("TXN_ID"), F.concat(F.lit("B"), F.year("o_orderdate").cast("string")).alias("_BATCH_ID"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )
    history = orders.drop("month")
    table = PartTable(spark, scratch_dir(spark, "random"), history.schema, part="_BATCH_ID", key=F.col("TXN_ID"))
    table.replace(history, spread=True)
    line = F.concat_ws("-", F.lit("new"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    added = b.table(spark, sf, "lineitem").select(F.md5(line).alias("TXN_ID"))
    batch = orders.where(F.col("month") == _AGAIN).select("TXN_ID").unionByName(added).distinct()
    bounds = batch.agg(F.count(F.lit(1)).alias("rows"), F.max(F.octet_length("TXN_ID")).alias("longest")).first()
    small = fits_broadcast(bounds.rows, bounds.longest or 0)
    stored = table.read(table.may_hold(batch, bounds.rows)) if small else table.read()
    repeats = stored.join(broadcast_bounded(batch, bounds.rows, bounds.longest or 0), "TXN_ID", "left_semi")
    counted = repeats.groupBy("_BATCH_ID").agg(F.count(F.lit(1)).alias("repeats"))
    years = table.items().select(F.col("part").alias("_BATCH_ID"), F.col("rows").alias("total_rows"))
    return years.join(counted, "_BATCH_ID", "left").fillna(0, ["repeats"])


def _references(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.txn_dirty(spark, sf)
    cases = [
        ("BAD_REF_ACCOUNT", raw, "ACCOUNT_ID", b.accounts(spark, sf), "ACCOUNT_ID"),
        ("BAD_REF_ACCOUNT_PART", raw, "ACCOUNT_ID", b.accounts(spark, sf, True), "ACCOUNT_ID"),
        ("BAD_REF_INSTRUMENT", raw, "INSTRUMENT_ID", b.instruments(spark, sf), "INSTRUMENT_ID"),
        ("BAD_REF_INSTRUMENT_PART", raw, "INSTRUMENT_ID", b.instruments(spark, sf, True), "INSTRUMENT_ID"),
        ("BAD_REF_PART", b.table(spark, sf, "lineitem"), "l_partkey", b.table(spark, sf, "part"), "p_partkey"),
    ]
    out = None
    for name, rows, key, ref, ref_key in cases:
        count = k.missing_references(rows, key, ref, ref_key).agg(F.count(F.lit(1)).alias(name))
        out = count if out is None else attach(out, count)
    return out


def _missing_sql(rows: str, key: str, ref: str, ref_key: str, name: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT DISTINCT {key} AS x FROM {rows}) q WHERE NOT EXISTS "
        f"(SELECT 1 FROM {ref} r WHERE r.{ref_key} = q.x)) AS {name}"
    )


REFERENCES_SQL = f"""WITH {b.DIRTY}, {b.REFERENCES} SELECT
  {_missing_sql('txn_dirty', 'ACCOUNT_ID', 'accounts', 'ACCOUNT_ID', 'BAD_REF_ACCOUNT')},
  {_missing_sql('txn_dirty', 'ACCOUNT_ID', 'accounts_part', 'ACCOUNT_ID', 'BAD_REF_ACCOUNT_PART')},
  {_missing_sql('txn_dirty', 'INSTRUMENT_ID', 'instruments', 'INSTRUMENT_ID', 'BAD_REF_INSTRUMENT')},
  {_missing_sql('txn_dirty', 'INSTRUMENT_ID', 'instruments_part', 'INSTRUMENT_ID', 'BAD_REF_INSTRUMENT_PART')},
  {_missing_sql('lineitem', 'l_partkey', 'part', 'p_partkey', 'BAD_REF_PART')}"""


def _missing_accounts(spark: SparkSession, sf: str) -> DataFrame:
    return k.missing_references(b.txn_raw(spark, sf), "ACCOUNT_ID", b.accounts(spark, sf, True), "ACCOUNT_ID")


def _provenance(spark: SparkSession, sf: str) -> DataFrame:
    """Months of line items in which no order was placed."""
    month = lambda t, c: b.table(spark, sf, t).select(F.date_format(c, "yyyy-MM").alias("_BATCH_ID"))
    return k.keys_without_origin(month("lineitem", "l_shipdate"), month("orders", "o_orderdate"), "_BATCH_ID")


LATEST_ORDER = ["_LOADED_AT", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def _dedupe(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.txn_multi(spark, sf)
    return b.plain(k.latest_per_key(rows, ["TXN_ID"], [F.col(c).desc() for c in LATEST_ORDER]))


def _latest_batch(spark: SparkSession, sf: str) -> DataFrame:
    batches = b.txn_raw(spark, sf).select(F.col("_FILENAME").alias("_BATCH_ID"), "_LOADED_AT")
    return b.plain(k.latest_part(batches, "_BATCH_ID", "_LOADED_AT"))


QUERIES = {
    "cross_batch_dups": Query(
        _cross_batch,
        f"""WITH {b.MULTI}, shared AS (SELECT TXN_ID FROM txn_multi GROUP BY 1
          HAVING count(DISTINCT _BATCH_ID) > 1)
        SELECT _BATCH_ID, count(s.TXN_ID) AS repeats FROM txn_multi m LEFT JOIN shared s USING (TXN_ID)
        GROUP BY _BATCH_ID""",
    ),
    "newest_batch_repeats": Query(
        _newest_against_history,
        f"""WITH {b.MULTI}, n AS (SELECT max(_BATCH_ID) AS b FROM txn_multi)
        SELECT count(*) - count(DISTINCT m.TXN_ID) AS duplicates, count(*) FILTER (m.TXN_ID IN
          (SELECT TXN_ID FROM txn_multi h, n WHERE h._BATCH_ID <> n.b)) AS repeats, max(n.b) AS _BATCH_ID
        FROM txn_multi m, n WHERE m._BATCH_ID = n.b""",
    ),
    "random_key_repeats": Query(
        _random_keys,
        f"""WITH o AS (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS TXN_ID, 'B' || CAST(year(o_orderdate) AS VARCHAR) AS _BATCH_ID,
          strftime(o_orderdate, '%Y-%m') AS month FROM orders),
        batch AS (SELECT TXN_ID FROM o WHERE month = '{_AGAIN}' UNION
          SELECT md5('new-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)) FROM lineitem)
        SELECT o._BATCH_ID, count(*) AS total_rows, count(n.TXN_ID) AS repeats FROM o LEFT JOIN batch n USING (TXN_ID) GROUP BY 1""",
    ),
    "ref_integrity": Query(_references, REFERENCES_SQL),
    "missing_accounts": Query(
        _missing_accounts,
        f"""WITH {b.RAW}, {b.REFERENCES} SELECT DISTINCT ACCOUNT_ID FROM txn_raw
        WHERE ACCOUNT_ID NOT IN (SELECT ACCOUNT_ID FROM accounts_part)""",
    ),
    "provenance": Query(
        _provenance,
        """SELECT DISTINCT strftime(l_shipdate, '%Y-%m') AS _BATCH_ID FROM lineitem
        WHERE strftime(l_shipdate, '%Y-%m') NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders)""",
    ),
    "dedupe_latest": Query(
        _dedupe,
        f"""WITH {b.MULTI} SELECT TXN_ID, _BATCH_ID, strftime(_LOADED_AT, '%Y-%m-%d %H:%M:%S') AS _LOADED_AT, l_partkey,
          l_suppkey, l_extendedprice, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY TXN_ID ORDER BY
          {', '.join(c + ' DESC' for c in LATEST_ORDER)}) AS rn FROM txn_multi) t WHERE rn = 1""",
    ),
    "latest_batch": Query(
        _latest_batch,
        f"""WITH {b.RAW} SELECT _FILENAME AS _BATCH_ID, strftime(_LOADED_AT, '%Y-%m-%d %H:%M:%S') AS latest_load
        FROM txn_raw ORDER BY txn_raw._LOADED_AT DESC, _FILENAME DESC LIMIT 1""",
    ),
}
