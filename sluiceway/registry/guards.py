"""What must not happen: half batches, unguarded calls, changed schemas, empty batches, bad deliveries that hold up good ones."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.operators.audit import AuditLog
from sluiceway.operators.upsert import merge_into
from sluiceway.operators.verdict import GateFailed
from sluiceway.plans import transactions as tx
from sluiceway.plans.cycle import run_cycle
from sluiceway.plans.gates import gate_mirror
from sluiceway.plans.store import Store
from sluiceway.registry import base as b
from sluiceway.registry.base import Query
from sluiceway.session import list_names, scratch_dir
from sluiceway.sources.listing import list_files, pending_files
from sluiceway.sources.loading import load_parquet
from sluiceway.sources.mirror import open_mirror
from sluiceway.sources.tables import PartTable, SchemaChanged
from sluiceway.sources.unload import unload_parquet
from sluiceway.streaming.gates import gate_stream, repeats_in_stream


def _store(spark: SparkSession, sf: str) -> Store:
    return Store(spark, scratch_dir(spark, "store"), b.accounts(spark, sf), b.instruments(spark, sf))


def _outcome(work) -> str:
    """`done`, or the kind of refusal; a file that cannot be read has no type of its own."""
    try:
        found = work()
    except (ValueError, SchemaChanged, GateFailed) as refused:
        return type(refused).__name__
    except Exception:  # noqa: BLE001 - raised by the reading job as an untyped error
        return "unreadable"
    return getattr(found, "status", None) or "done"


def _load_guards(spark: SparkSession, sf: str) -> DataFrame:
    """Loads without a list, with an empty one, with a damaged file among good ones, and then of the good ones: outcome and rows."""
    mirror, landing = open_mirror(spark, scratch_dir(spark, "mirror")), scratch_dir(spark, "landing")
    unload_parquet(b.txn_raw(spark, sf).select(*tx.KEYS), f"{landing}/good")
    good = pending_files(spark, landing, mirror, "*.parquet")
    spark.createDataFrame([("no parquet",)], "value string").coalesce(1).write.text(f"{landing}/bad.parquet")
    bad = [r.path for r in list_files(spark, f"{landing}/bad.parquet", "*.txt").select("path").collect()]
    found = []
    for case, files in (("no list", None), ("no files", []), ("damaged", good + bad), ("good", good), ("again", good)):
        outcome = _outcome(lambda: load_parquet(spark, mirror, files, {"BATCH_ID": "one"}, base=landing))  # noqa: B023
        found.append(mirror.read().agg(F.lit(case).alias("kind"), F.lit(outcome).alias("outcome"), F.count("*").alias("rows")))
        found[-1] = spark.createDataFrame(found[-1].collect(), "kind string, outcome string, rows bigint")
    return _all(found)


def _all(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


GUARDS_SQL = """SELECT kind, outcome, CASE WHEN kind IN ('good', 'again') THEN n ELSE 0 END AS rows FROM (SELECT count(*) AS n FROM orders),
  (VALUES ('no list', 'ValueError'), ('no files', 'EMPTY'), ('damaged', 'unreadable'), ('good', 'LOADED'), ('again', 'LOADED')) v(kind, outcome)"""


def _schema_change(spark: SparkSession, sf: str) -> DataFrame:
    """Merges into a table of orders: the same columns in another order, one more, one less, another type; rows and sum after each."""
    o = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"), F.lit("p").alias("part"))
    table = PartTable(spark, scratch_dir(spark, "table"), o.schema, part="part")
    table.replace(o.where("k % 2 = 0"))
    rest = o.where("k % 2 = 1")
    found = []
    for case, rows in (
        ("more", rest.withColumn("w", F.lit(1))), ("less", rest.drop("v")), ("retyped", rest.withColumn("v", F.col("v").cast("double"))),
        ("reordered", rest.select("part", "v", "k")),
    ):
        outcome = _outcome(lambda: merge_into(table, rows, ["k"]) and None)  # noqa: B023
        total = table.read().agg(F.count("*").alias("rows"), F.sum("k").cast("bigint").alias("keys")).first()
        found.append((case, outcome, total["rows"], total["keys"]))
    return spark.createDataFrame(found, "kind string, outcome string, rows bigint, keys bigint")


SCHEMA_SQL = """SELECT kind, outcome, count(*) FILTER (kind = 'reordered' OR o_orderkey % 2 = 0) AS rows,
  CAST(sum(o_orderkey) FILTER (kind = 'reordered' OR o_orderkey % 2 = 0) AS BIGINT) AS keys FROM orders,
  (VALUES ('more', 'SchemaChanged'), ('less', 'SchemaChanged'), ('retyped', 'SchemaChanged'), ('reordered', 'done')) v(kind, outcome)
  GROUP BY kind, outcome"""


def _empty_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch of a file without rows stops at the first gate, is logged, and does not disturb the batch after it."""
    store, landing = _store(spark, sf), scratch_dir(spark, "landing")
    rows = b.txn_raw(spark, sf).select(*tx.KEYS)
    unload_parquet(rows.limit(0), f"{landing}/none")
    run_cycle(store, landing, context={"BATCH_ID": "none"})
    _outcome(lambda: gate_mirror(store, "never loaded"))
    unload_parquet(rows, f"{landing}/all")
    run_cycle(store, landing, context={"BATCH_ID": "all"})
    logged = store.audit.table("TDQ_RESULTS").where("LAYER = 'ML'")
    return logged.select("BATCH_ID", "PASSED", "ROW_COUNT", F.variant_get("FAILED_DETAILS", "$[0]", "string").alias("detail"))


EMPTY_SQL = """SELECT 'none' AS BATCH_ID, FALSE AS PASSED, CAST(0 AS BIGINT) AS ROW_COUNT, 'no rows' AS detail
  UNION ALL SELECT 'never loaded', FALSE, 0, 'no rows' UNION ALL SELECT 'all', TRUE, count(*), NULL FROM orders"""


def _gate_results(spark: SparkSession, sf: str) -> DataFrame:
    """What a run returns: layer, table, verdict, rows of the batch and of the table, checks and failures of every gate."""
    store, landing = _store(spark, sf), scratch_dir(spark, "landing")
    rows = b.txn_raw(spark, sf).select(*tx.KEYS)
    results = []
    for name, part in (("one", rows.where("TXN_DATE < '1999-01-01'")), ("two", rows.where("TXN_DATE >= '1999-01-01'"))):
        unload_parquet(part, f"{landing}/{name}")
        results.append(run_cycle(store, landing, context={"BATCH_ID": name}))
    found = [
        (r.batch_id, r.status, g.layer, g.table, g.success, g.batch_rows, g.total_rows, len(g.checks), len(g.failed))
        for r in results for g in r.gates
    ]
    return spark.createDataFrame(
        found, "batch string, status string, layer string, name string, success boolean, batch_rows bigint, total_rows bigint, checks bigint, failed bigint"
    )


RESULTS_SQL = """WITH n AS (SELECT count(*) FILTER (o_orderdate < '1999-01-01') AS one, count(*) AS every FROM orders),
g AS (SELECT * FROM (VALUES ('ML', 'mirror', 17), ('STG', 'staging', 13), ('SDM', 'mart', 17)) v(layer, name, checks))
SELECT 'one' AS batch, 'SUCCESS' AS status, layer, name, TRUE AS success, one AS batch_rows, one AS total_rows,
  CAST(checks AS BIGINT) AS checks, CAST(0 AS BIGINT) AS failed FROM n, g
UNION ALL SELECT 'two', 'SUCCESS', layer, name, TRUE, every - one, CASE layer WHEN 'SDM' THEN every ELSE every - one END, checks, 0 FROM n, g"""


# ---- streams that go on ------------------------------------------------------------


_FILE_ROWS = 1_000_000


def _by_year(spark: SparkSession, rows: DataFrame, year_of: Column, years: list[int]) -> DataFrame:
    """The rows as a stream of one year per trigger, each year in the same number of files, written by as many tasks."""
    path, none = scratch_dir(spark, "arrivals"), spark.createDataFrame([], rows.schema)
    counts = rows.groupBy(year_of.alias("y")).count().where(F.col("y").isin(years))
    most = counts.agg(F.max("count")).first()[0] or 0
    files = max(1, ceil(most / _FILE_ROWS))
    for i, year in enumerate(years):
        rows.where(year_of == year).repartition(files).write.mode("append").parquet(path)
        # A task without rows writes no file; files without rows take their places, so that triggers keep to the years.
        for _ in range((i + 1) * files - len([n for n in list_names(spark, path) if n.endswith(".parquet")])):
            none.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


_YEARS = list(range(1995, 2002))


def _quarantined(spark: SparkSession, sf: str) -> DataFrame:
    """A stream of seven micro-batches of which one has an unknown currency: it is set aside, the others are accepted, each is logged once."""
    year = F.year(F.to_date("TXN_DATE"))
    currency = F.when(year == 1997, "XXX").otherwise(F.col("CURRENCY"))
    rows = b.txn_raw(spark, sf).drop("k").withColumn("CURRENCY", currency).withColumn("_BATCH_ID", F.concat(F.lit("B"), year.cast("string")))
    log, path = AuditLog(spark, scratch_dir(spark, "audit")), scratch_dir(spark, "stream")
    gate_stream(
        _by_year(spark, rows, F.year(F.to_date("TXN_DATE")), _YEARS), tx.mirror_suite(), "TXN_ID", ["_BATCH_ID"], log, f"{path}/verdicts", f"{path}/progress",
        "DUP_TXN_ID_IN_BATCH", accepted=f"{path}/accepted", quarantine=f"{path}/quarantine",
    ).awaitTermination()
    logged = log.table("TDQ_RESULTS").groupBy("PASSED").agg(F.count("*").alias("epochs"))
    counts = [spark.read.parquet(f"{path}/{kind}").groupBy("_BATCH_ID").count().withColumn("went", F.lit(kind)) for kind in ("accepted", "quarantine")]
    ok = F.col("went") == "accepted"
    return counts[0].unionByName(counts[1]).join(logged, ok == F.col("PASSED")).drop("PASSED")


QUARANTINE_SQL = """SELECT 'B' || year(o_orderdate) AS _BATCH_ID, count(*) AS count, CASE year(o_orderdate) WHEN 1997 THEN 'quarantine' ELSE 'accepted' END AS went,
  CAST(CASE year(o_orderdate) WHEN 1997 THEN 1 ELSE 6 END AS BIGINT) AS epochs FROM orders GROUP BY year(o_orderdate)"""


def _many_epochs(spark: SparkSession, sf: str) -> DataFrame:
    """Repeats per epoch of line-item keys that arrive a year at a time, after the stored keys have been gathered into runs."""
    rows = b.txn_multi(spark, sf).select("TXN_ID", F.year("_LOADED_AT").alias("y"))
    path, stream = scratch_dir(spark, "repeats"), _by_year(spark, rows, F.col("y"), _YEARS).select("TXN_ID")
    repeats_in_stream(stream, "TXN_ID", scratch_dir(spark, "keys"), path, scratch_dir(spark, "progress")).awaitTermination()
    return spark.read.parquet(path).select((F.col("epoch") + _YEARS[0]).alias("y"), "repeats")


EPOCHS_SQL = f"""WITH {b.MULTI}, m AS (SELECT TXN_ID, year(_LOADED_AT) AS y FROM txn_multi WHERE TXN_ID IS NOT NULL),
f AS (SELECT y, count(*) AS n, count(*) FILTER (first_y = y) AS own FROM (SELECT *, min(y) OVER (PARTITION BY TXN_ID) AS first_y FROM m) GROUP BY y),
d AS (SELECT y, count(DISTINCT TXN_ID) AS fresh FROM (SELECT TXN_ID, min(y) AS y FROM m GROUP BY TXN_ID) GROUP BY y)
SELECT CAST(f.y AS INTEGER) AS y, n - coalesce(fresh, 0) AS repeats FROM f LEFT JOIN d ON d.y = f.y"""

QUERIES = {
    "load_guards": Query(_load_guards, GUARDS_SQL),
    "schema_change": Query(_schema_change, SCHEMA_SQL),
    "empty_batch": Query(_empty_batch, EMPTY_SQL),
    "gate_results": Query(_gate_results, RESULTS_SQL),
    "stream_quarantine": Query(_quarantined, QUARANTINE_SQL),
    "stream_many_epochs": Query(_many_epochs, EPOCHS_SQL),
}
