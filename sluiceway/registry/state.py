"""What is kept between runs: late batches, second deliveries, stopped cycles, streams, file logs; full gate verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.keys import KeyBounds, key_metrics, keys_without_origin, missing_references
from sluiceway.operators.profile import attach, duplicate_metric, fused_metrics
from sluiceway.operators.verdict import verdicts
from sluiceway.plans import transactions as tx
from sluiceway.plans.cycle import refresh_mart, run_cycle, stage_new_rows
from sluiceway.plans.store import Store
from sluiceway.registry import base as b
from sluiceway.registry.base import Query
from sluiceway.registry.checks import BATCH, GATE3_SQL, STAGED, _gate3, _staged
from sluiceway.session import scratch_dir
from sluiceway.sources.listing import list_files, pending_files
from sluiceway.sources.loading import load_csv, load_parquet
from sluiceway.sources.mirror import open_mirror
from sluiceway.sources.unload import unload_csv, unload_parquet
from sluiceway.streaming.pickup import pick_up

SPLIT = "1999-01-01"
_LATE = f"_LOADED_AT >= TIMESTAMP '{SPLIT} 00:00:00'"


def _store(spark: SparkSession, sf: str) -> Store:
    return Store(spark, scratch_dir(spark, "store"), b.accounts(spark, sf), b.instruments(spark, sf))


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = b.txn_raw(spark, sf)
    late = F.col("_LOADED_AT") >= SPLIT
    return rows.where(~late).select(*tx.KEYS), rows.where(late).select(*tx.KEYS)


# ---- batches ---------------------------------------------------------------


def _late_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Of two loaded batches the newer one passes, and is staged, first."""
    store, landing = _store(spark, sf), scratch_dir(spark, "landing")
    for name, rows in zip(["first", "second"], _halves(spark, sf)):
        unload_parquet(rows, f"{landing}/{name}")
        files = pending_files(spark, landing, store.mirror, "*.parquet")
        load_parquet(spark, store.mirror, files, {"BATCH_ID": name}, base=landing)
    for name in ["second", "first"]:
        store.approve(name)
        stage_new_rows(store)
    return b.plain(store.staging.read().drop("_LOADED_AT", "_FILENAME"))


_NAMED = f"named AS (SELECT * REPLACE (CASE WHEN {_LATE} THEN 'second' ELSE 'first' END AS _BATCH_ID) FROM typed)"
LATE_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw')}, {_NAMED} SELECT TXN_ID, ACCOUNT_ID, INSTRUMENT_ID,
  CAST(AMOUNT AS DOUBLE) AS AMOUNT, CURRENCY, {b.day_text('TXN_DATE')}, {b.day_text('SETTLEMENT_DATE')}, STATUS, _BATCH_ID
  FROM named"""


def _two_deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries under one batch id, the second one sent twice."""
    mirror, landing = open_mirror(spark, scratch_dir(spark, "mirror")), scratch_dir(spark, "landing")
    for name, rows in zip(["first", "second", "second"], [*_halves(spark, sf), None]):
        if rows is not None:
            unload_parquet(rows, f"{landing}/{name}")
        files = [r.path for r in list_files(spark, f"{landing}/{name}", "*.parquet").select("path").collect()]
        load_parquet(spark, mirror, files, {"BATCH_ID": "both"}, base=landing)
    rows = tx.mirror_keys(mirror.read())
    return rows.select(*tx.KEYS, F.substring_index("_FILENAME", "/", 1).alias("folder"), "_BATCH_ID")


DELIVERIES_SQL = f"""WITH {b.RAW} SELECT {', '.join(tx.KEYS)}, CASE WHEN {_LATE} THEN 'second' ELSE 'first' END AS folder,
  'both' AS _BATCH_ID FROM txn_raw"""


def _two_streams(spark: SparkSession, sf: str) -> DataFrame:
    """A Parquet and a CSV stream, each with its own checkpoint, into one mirror."""
    mirror, landing = open_mirror(spark, scratch_dir(spark, "mirror")), scratch_dir(spark, "landing")
    first, second = _halves(spark, sf)
    unload_parquet(first, f"{landing}/first")
    unload_csv(second, f"{landing}/second")
    for kind in ["parquet", "csv"]:
        pick_up(spark, landing, mirror, scratch_dir(spark, "progress"), kind).awaitTermination()
    rows = tx.mirror_keys(mirror.read())
    return rows.select(*tx.KEYS, F.substring_index("_FILENAME", "/", 1).alias("folder"))


STREAMS_SQL = f"""WITH {b.RAW} SELECT {', '.join(tx.KEYS)}, CASE WHEN {_LATE} THEN 'second' ELSE 'first' END AS folder
  FROM txn_raw"""


# ---- headers and the file log ------------------------------------------------


def _header_only(spark: SparkSession, sf: str) -> DataFrame:
    """A delivery with a file that holds a header and nothing else; then nothing is pending."""
    mirror, landing = open_mirror(spark, scratch_dir(spark, "mirror")), scratch_dir(spark, "landing")
    unload_csv(b.txn_raw(spark, sf).select(*tx.KEYS), f"{landing}/full")
    spark.createDataFrame([(",".join(tx.KEYS),)], "value string").coalesce(1).write.text(f"{landing}/empty")
    files = [r.path for r in list_files(spark, landing).where("path LIKE '%.csv' OR path LIKE '%.txt'").select("path").collect()]
    found = load_csv(spark, mirror, files, {"BATCH_ID": "one"}, base=landing)
    pending = len(pending_files(spark, landing, mirror))
    items = mirror.items().groupBy(F.substring_index("item", "/", 1).alias("folder")).agg(F.sum("rows").alias("rows"))
    # The full files count as one, however many tasks wrote them.
    loaded = found.files - sum(f.endswith(".csv") for f in files) + 1
    return items.withColumns({"files": F.lit(loaded).cast("bigint"), "pending": F.lit(pending).cast("bigint")})


def _quoted_comma(spark: SparkSession, sf: str) -> DataFrame:
    """Two headers that read alike once joined: one name with a comma, and two names."""
    mirror, landing = open_mirror(spark, scratch_dir(spark, "mirror")), scratch_dir(spark, "landing")
    o = b.table(spark, sf, "orders")
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    unload_csv(o.where("o_orderkey % 2 = 0").select(key.alias("a,b"), customer.alias("c")), f"{landing}/two")
    three = o.where("o_orderkey % 2 <> 0").select(key.alias("a"), customer.alias("b"), F.lit("x").alias("c"))
    unload_csv(three, f"{landing}/three")
    files = [r.path for r in list_files(spark, landing, "*.csv").select("path").collect()]
    load_csv(spark, mirror, files, {"BATCH_ID": "one"}, base=landing)
    keyed = mirror.read().withColumn("text", F.to_json("RAW_DATA"))
    return keyed.select(
        F.substring_index("_FILENAME", "/", 1).alias("folder"), F.col("text").alias("row_text")
    )


QUOTED_SQL = """SELECT 'two' AS folder, '{"a,b":"' || o_orderkey || '","c":"' || o_custkey || '"}' AS row_text
  FROM orders WHERE o_orderkey % 2 = 0 UNION ALL
  SELECT 'three', '{"a":"' || o_orderkey || '","b":"' || o_custkey || '","c":"x"}' FROM orders WHERE o_orderkey % 2 <> 0"""


# ---- cycles ------------------------------------------------------------------


def _stopped_cycles(spark: SparkSession, sf: str) -> Store:
    """Four deliveries: good, unknown instruments (stops at gate 2), unknown currency (at gate 1), good."""
    store, landing = _store(spark, sf), scratch_dir(spark, "landing")
    year = F.year(F.to_date("TXN_DATE"))
    rows = b.txn_raw(spark, sf).select(*tx.KEYS)
    parts = {
        "a": rows.where(year < 1997),
        "b": rows.where(year == 1997).withColumn("INSTRUMENT_ID", F.lit("INST-none")),
        "c": rows.where(year == 1998).withColumn("CURRENCY", F.lit("XXX")),
        "d": rows.where(year > 1998),
    }
    for name, part in parts.items():
        unload_parquet(part, f"{landing}/{name}")
        run_cycle(store, landing, context={"BATCH_ID": name})
    return store


def _after_stop(spark: SparkSession, sf: str) -> DataFrame:
    """The mart holds all of staging, also what a stopped run had left out."""
    return b.plain(_stopped_cycles(spark, sf).mart_rows().drop("_LOADED_AT"))


STOP_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw')}, named AS (SELECT * REPLACE (
  CASE WHEN year(TXN_DATE) < 1997 THEN 'a' WHEN year(TXN_DATE) = 1997 THEN 'b' ELSE 'd' END AS _BATCH_ID,
  CASE WHEN year(TXN_DATE) = 1997 THEN 'INST-none' ELSE INSTRUMENT_ID END AS INSTRUMENT_ID)
  FROM typed WHERE year(TXN_DATE) <> 1998), {b.mart_sql('named')}
SELECT {b.MART_SQL.replace(b.time_text('_LOADED_AT') + ', ', '')} FROM mart"""


def _cycle_results(spark: SparkSession, sf: str) -> DataFrame:
    """Result, benchmark and run rows of passing and stopped batches, without clock columns."""
    audit = _stopped_cycles(spark, sf).audit
    details = F.array_join(F.array_sort(F.from_json(F.to_json("FAILED_DETAILS"), "array<string>")), ";")
    results = audit.table("TDQ_RESULTS").select(
        F.lit("TDQ_RESULTS").alias("kind"), "BATCH_ID", "LAYER", "PASSED", "ROW_COUNT", "TOTAL_CHECKS", details.alias("notes")
    )
    speed = audit.table("PERFORMANCE_BENCHMARKS").select(
        F.lit("PERFORMANCE_BENCHMARKS").alias("kind"), F.lit(None).cast("string").alias("BATCH_ID"), "LAYER",
        F.lit(None).cast("boolean").alias("PASSED"), "ROW_COUNT", F.lit(None).cast("bigint").alias("TOTAL_CHECKS"), F.col("NOTES").alias("notes"),
    )
    runs = audit.table("PIPELINE_RUNS").select(
        F.lit("PIPELINE_RUNS").alias("kind"), "BATCH_ID", F.col("STATUS").alias("LAYER"), F.col("SDM_BDQ_PASSED").alias("PASSED"),
        F.lit(None).cast("bigint").alias("ROW_COUNT"),
        (F.col("ML_TDQ_PASSED").cast("int") + F.col("STG_BDQ_PASSED").cast("int")).cast("bigint").alias("TOTAL_CHECKS"), F.lit("").alias("notes"),
    )
    return results.unionByName(speed).unionByName(runs)


RESULTS_SQL = f"""WITH {b.RAW}, n AS (SELECT CASE WHEN y < 1997 THEN 'a' WHEN y = 1997 THEN 'b' WHEN y = 1998 THEN 'c' ELSE 'd' END AS x,
    count(*) AS c FROM (SELECT year(CAST(TXN_DATE AS DATE)) AS y FROM txn_raw) GROUP BY 1),
l AS (SELECT * FROM (VALUES ('ML', 17), ('STG', 13), ('SDM', 17)) v(layer, checks))
SELECT 'TDQ_RESULTS' AS kind, x AS BATCH_ID, layer AS LAYER, NOT (x = 'c' OR (x = 'b' AND layer = 'STG')) AS PASSED, c AS ROW_COUNT,
  CAST(checks AS BIGINT) AS TOTAL_CHECKS, CASE WHEN x = 'c' THEN 'BAD_DOMAIN_CURRENCY: FAILED: value=' || c || '.0'
    WHEN x = 'b' AND layer = 'STG' THEN 'BAD_REF_INSTRUMENT: FAILED: value=1.0' ELSE '' END AS notes
  FROM n, l WHERE x IN ('a', 'd') OR layer = 'ML' OR (x = 'b' AND layer = 'STG')
UNION ALL SELECT 'PERFORMANCE_BENCHMARKS', NULL, 'ML', NULL, c, NULL, 'fused metrics (' || c || ' rows)' FROM n
UNION ALL SELECT 'PIPELINE_RUNS', x, CASE WHEN x IN ('a', 'd') THEN 'SUCCESS' ELSE 'FAILED' END, x IN ('a', 'd'), NULL,
  CAST(CASE x WHEN 'b' THEN 1 WHEN 'c' THEN 0 ELSE 2 END AS BIGINT), '' FROM n"""


def _month_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """The mart after a second delivery of the last months; `untouched` months are still shown as the first refresh wrote them."""
    store, landing = _store(spark, sf), scratch_dir(spark, "landing")
    rows = b.txn_raw(spark, sf).select(*tx.KEYS)
    last = F.col("TXN_DATE") >= "2001-05-01"
    before = {}
    for name, part in (("first", rows.where(~last)), ("second", rows.where(last))):
        before = store.mart.live_parts()
        unload_parquet(part, f"{landing}/{name}")
        load_parquet(spark, store.mirror, pending_files(spark, landing, store.mirror, "*.parquet"), {"BATCH_ID": name}, base=landing)
        store.approve(name)
        stage_new_rows(store)
        refresh_mart(store)
    now = store.mart.live_parts()
    untouched = sum(now[month] == versions for month, versions in before.items())
    return b.plain(store.mart_rows().drop("_LOADED_AT")).withColumn("untouched", F.lit(untouched).cast("bigint"))


MONTHS_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw')}, named AS (SELECT * REPLACE (
  CASE WHEN TXN_DATE < DATE '2001-05-01' THEN 'first' ELSE 'second' END AS _BATCH_ID) FROM typed), {b.mart_sql('named')}
SELECT {b.MART_SQL.replace(b.time_text('_LOADED_AT') + ', ', '')},
  (SELECT count(DISTINCT date_trunc('month', TXN_DATE)) FROM typed WHERE TXN_DATE < DATE '2001-05-01') AS untouched FROM mart"""


# ---- runs that broke off -------------------------------------------------------


def _crash_after_load(spark: SparkSession, sf: str) -> DataFrame:
    """A run dies right after its load; the next one, with files of its own, takes both batches to the mart."""
    store, landing = _store(spark, sf), scratch_dir(spark, "landing")
    first, second = _halves(spark, sf)
    unload_parquet(first, f"{landing}/first")
    files = pending_files(spark, landing, store.mirror, "*.parquet")
    load_parquet(spark, store.mirror, files, {"BATCH_ID": "first"}, base=landing)
    unload_parquet(second, f"{landing}/second")
    run_cycle(store, landing, context={"BATCH_ID": "second"})
    runs = store.audit.table("PIPELINE_RUNS").where("SDM_BDQ_PASSED").select(F.col("BATCH_ID").alias("_BATCH_ID"), F.col("STATUS").alias("run"))
    return b.plain(store.mart_rows().drop("_LOADED_AT")).join(runs, "_BATCH_ID", "left")


CRASH_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw')}, {_NAMED}, {b.mart_sql('named')}
SELECT {b.MART_SQL.replace(b.time_text('_LOADED_AT') + ', ', '')}, 'SUCCESS' AS run FROM mart"""


def _broken_deliveries(spark: SparkSession, sf: str) -> Store:
    """Batch A passes; a bad second delivery of it is loaded by a run that dies; a good run of batch B follows."""
    store, landing = _store(spark, sf), scratch_dir(spark, "landing")
    year = F.year(F.to_date("TXN_DATE"))
    rows = b.txn_raw(spark, sf).select(*tx.KEYS)
    unload_parquet(rows.where(year < 1997), f"{landing}/a")
    run_cycle(store, landing, context={"BATCH_ID": "A"})
    unload_parquet(rows.where(year == 1997).withColumn("CURRENCY", F.lit("XXX")), f"{landing}/more")
    files = pending_files(spark, landing, store.mirror, "*.parquet")
    load_parquet(spark, store.mirror, files, {"BATCH_ID": "A"}, base=landing)
    unload_parquet(rows.where(year > 1997), f"{landing}/b")
    run_cycle(store, landing, context={"BATCH_ID": "B"})
    return store


def _ungated_delivery(spark: SparkSession, sf: str) -> DataFrame:
    """What reached staging: the deliveries that passed, and not the rest of their batch."""
    return b.plain(_broken_deliveries(spark, sf).staging.read().drop("_LOADED_AT", "_FILENAME"))


UNGATED_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw')} SELECT TXN_ID, ACCOUNT_ID, INSTRUMENT_ID,
  CAST(AMOUNT AS DOUBLE) AS AMOUNT, CURRENCY, {b.day_text('TXN_DATE')}, {b.day_text('SETTLEMENT_DATE')}, STATUS,
  CASE WHEN year(TXN_DATE) < 1997 THEN 'A' ELSE 'B' END AS _BATCH_ID FROM typed WHERE year(TXN_DATE) <> 1997"""


def _delivery_states(spark: SparkSession, sf: str) -> DataFrame:
    """State of every delivery, with its rows in the mirror."""
    store = _broken_deliveries(spark, sf)
    states = store.ledger.latest(store.ledger.log.read()).select("version", "state")
    sizes = store.mirror.items().groupBy(F.col("part").alias("batch"), "version").agg(F.sum("rows").alias("rows"))
    return sizes.join(states, "version", "left").select("batch", "state", "rows")


STATES_SQL = f"""WITH {b.RAW}, {b.typed_sql('txn_raw')}, y AS (SELECT year(TXN_DATE) AS y FROM typed)
SELECT 'A' AS batch, 'served' AS state, count(*) AS rows FROM y WHERE y < 1997
UNION ALL SELECT 'A', 'failed', count(*) FROM y WHERE y = 1997 UNION ALL SELECT 'B', 'served', count(*) FROM y WHERE y > 1997"""


# ---- verdicts of all checks ----------------------------------------------------

SHOWN = ["metric", "value", "passed"]
_NEWEST = "B2001"
_AS_OF = f"TIMESTAMP '{b.ORDERS_AS_OF}'"


def _gate1_full(spark: SparkSession, sf: str) -> DataFrame:
    """All 17 checks of the newest batch, with its repeats of earlier keys and its age."""
    rows = b.txn_dirty(spark, sf)
    batch, history = rows.where(F.col("_BATCH_ID") == _NEWEST), rows.where(F.col("_BATCH_ID") != _NEWEST)
    suite = tx.mirror_suite(F.lit(b.ORDERS_AS_OF).cast("timestamp_ntz"))
    bounds = KeyBounds.of(batch.count(), fused_metrics(batch, KeyBounds.metrics("TXN_ID")).first())
    keys = key_metrics(batch, history, "TXN_ID", bounds, "DUP_TXN_ID_IN_BATCH", "cross_batch_dup_txn_ids")
    return verdicts(attach(fused_metrics(batch, suite), keys), suite).select(*SHOWN)


def _gate2_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """All 13 checks over all batches at once, against incomplete references and a mirror that lost a batch."""
    rows, suite = _staged(spark, sf), tx.staging_suite()
    metrics = attach(fused_metrics(rows, suite), duplicate_metric(rows, "TXN_ID", "DUP_TXN_ID"))
    known = rows.where("_BATCH_ID <> 'B1996'")
    for name, missing in [
        ("BAD_REF_ACCOUNT", missing_references(rows, "ACCOUNT_ID", b.accounts(spark, sf, True), "ACCOUNT_ID")),
        ("BAD_REF_INSTRUMENT", missing_references(rows, "INSTRUMENT_ID", b.instruments(spark, sf, True), "INSTRUMENT_ID")),
        ("batch_ids_exist_in_mirror", keys_without_origin(rows, known, "_BATCH_ID")),
    ]:
        metrics = attach(metrics, missing.agg(F.count(F.lit(1)).alias(name)))
    return verdicts(metrics.withColumn("MISSING_SCHEMA_COLS", F.lit(0)), suite).select(*SHOWN)


def _gate3_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """The 11 batch checks of the mart, judged for every batch."""
    return verdicts(_gate3(spark, sf), tx.mart_suite(), BATCH).select("_BATCH_ID", *SHOWN)


def _judged(metrics: str, by: str = "") -> str:
    star = f"* EXCLUDE ({by})" if by else "*"
    return f"""SELECT {by + ', ' if by else ''}metric, CAST(n AS DOUBLE) AS value, CASE WHEN metric = 'TOTAL_ROWS' THEN n >= 1
  WHEN metric = 'loaded_within_7_days' THEN n <= 604800 ELSE n = 0 END AS passed
  FROM (UNPIVOT (SELECT COLUMNS({star})::BIGINT {', ' + by if by else ''} FROM {metrics}) ON COLUMNS({star}) INTO NAME metric VALUE n) u"""


def _gate1_full_sql() -> str:
    from sluiceway.registry.checks import GATE1_SQL

    return f"""WITH {b.DIRTY}, {GATE1_SQL}, old AS (SELECT DISTINCT TXN_ID FROM txn_dirty WHERE _BATCH_ID <> '{_NEWEST}' AND TXN_ID IS NOT NULL),
one AS (SELECT * EXCLUDE (_BATCH_ID), (SELECT count(*) FROM txn_dirty WHERE _BATCH_ID = '{_NEWEST}'
    AND TXN_ID IN (SELECT TXN_ID FROM old)) AS cross_batch_dup_txn_ids,
  (SELECT CAST(floor((epoch_us({_AS_OF}) - epoch_us(max(_LOADED_AT))) / 1000000.0) AS BIGINT) FROM txn_dirty
    WHERE _BATCH_ID = '{_NEWEST}') AS loaded_within_7_days FROM gate1 WHERE _BATCH_ID = '{_NEWEST}')
{_judged('one')}"""


GATE2_VERDICT_SQL = f"""WITH {STAGED}, {b.REFERENCES}, one AS (SELECT
  count(*) FILTER (TXN_ID IS NULL) AS NULL_TXN_ID, count(*) FILTER (ACCOUNT_ID IS NULL) AS NULL_ACCOUNT_ID,
  count(*) FILTER (AMOUNT IS NULL) AS NULL_AMOUNT, count(*) FILTER (TXN_DATE IS NULL) AS NULL_TXN_DATE,
  count(*) - count(DISTINCT TXN_ID) AS DUP_TXN_ID,
  count(*) FILTER (CURRENCY NOT IN ('USD','EUR','GBP','JPY','CHF')) AS BAD_DOMAIN_CURRENCY,
  count(*) FILTER (STATUS NOT IN ('PENDING','SETTLED','CANCELLED','FAILED')) AS BAD_DOMAIN_STATUS,
  count(*) FILTER (AMOUNT <= 0 OR AMOUNT > 100000000) AS BAD_RANGE_AMOUNT,
  (SELECT count(*) FROM (SELECT DISTINCT ACCOUNT_ID FROM typed_ok WHERE ACCOUNT_ID IS NULL OR ACCOUNT_ID NOT IN (SELECT ACCOUNT_ID FROM accounts_part)) x) AS BAD_REF_ACCOUNT,
  (SELECT count(*) FROM (SELECT DISTINCT INSTRUMENT_ID FROM typed_ok WHERE INSTRUMENT_ID IS NULL OR INSTRUMENT_ID NOT IN (SELECT INSTRUMENT_ID FROM instruments_part)) x)
    AS BAD_REF_INSTRUMENT,
  0 AS MISSING_SCHEMA_COLS, count(*) AS TOTAL_ROWS, 1 AS batch_ids_exist_in_mirror FROM typed_ok)
{_judged('one')}"""

QUERIES = {
    "late_passed_batch": Query(_late_batch, LATE_SQL),
    "batch_two_deliveries": Query(_two_deliveries, DELIVERIES_SQL),
    "two_streams": Query(_two_streams, STREAMS_SQL),
    "header_only_files": Query(
        _header_only,
        """SELECT 'full' AS folder, count(*) AS rows, CAST(2 AS BIGINT) AS files, CAST(0 AS BIGINT) AS pending FROM orders
        UNION ALL SELECT 'empty', 0, 2, 0""",
    ),
    "quoted_comma_headers": Query(_quoted_comma, QUOTED_SQL),
    "mart_month_refresh": Query(_month_refresh, MONTHS_SQL),
    "crash_after_load": Query(_crash_after_load, CRASH_SQL),
    "ungated_delivery": Query(_ungated_delivery, UNGATED_SQL),
    "delivery_states": Query(_delivery_states, STATES_SQL),
    "cycle_after_gate2_stop": Query(_after_stop, STOP_SQL),
    "cycle_results": Query(_cycle_results, RESULTS_SQL),
    "gate1_full": Query(_gate1_full, _gate1_full_sql()),
    "gate2_verdict": Query(_gate2_verdict, GATE2_VERDICT_SQL),
    "gate3_verdict": Query(_gate3_verdict, f"WITH g AS ({GATE3_SQL}) {_judged('g', '_BATCH_ID')}"),
}
