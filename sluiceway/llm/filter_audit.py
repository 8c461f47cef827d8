"""How five filters interact: what each removes, at each place of each order, kept up to date by a stream.

Which filters a text fails is a mask of five bits.  All figures follow from the number of documents per part, mask and
label, so the stream keeps only such counters.  Four filters judge a text alone; the fifth (E) fails a document if
a smaller id has the same text anywhere, so what was counted before may turn out wrong: when a smaller id arrives for a
known text, its earlier holder is retracted under its old mask and counted again under the new one.

Documents are read by a file stream in available-now micro-batches.  The state is keyed by text digest: the smallest id and
how often, in which part and with which labels it was seen.  State and counter changes are written below
the epoch's own folder, and an epoch reads only earlier ones, so a repeated epoch replaces itself and nothing is counted twice.
State grows by one row per new or lowered minimum; rows of one text are added up in the tasks before they
are shuffled, so a text that a third of all rows share is a few rows per task.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.graph import store
from sluiceway.llm.text import words
from sluiceway.session import list_names, scratch_dir

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
SYMBOLS = "[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROUNDS = 4  # micro-batches that the files are dealt to

REPEATED = 1 << FILTERS.index("E")
ORDERS = ["".join(p) for p in permutations(FILTERS)]
# One entry per order and step: the bit of the step's filter and the bits of the filters before it.
STEPS = [
    (order, step + 1, 1 << FILTERS.index(order[step]), sum(1 << FILTERS.index(f) for f in order[:step]))
    for order in ORDERS
    for step in range(len(FILTERS))
]
_KIND = ["part", "mask", "good", "toxic"]
_STATE = "digest binary, part string, mask int, good boolean, toxic boolean, id bigint, holders bigint"
_CHANGES = "part string, mask int, good boolean, toxic boolean, n bigint"


def mask(text: Column) -> Column:
    """Bits of the failed filters among those that judge a text alone."""
    upper = F.char_length(text) - F.char_length(F.translate(text, UPPER, ""))
    split = words(text)
    n, distinct = F.size(split), F.size(F.array_distinct(split))
    failed = [
        n < MIN_WORDS,
        distinct * 100 < n * MIN_DISTINCT_PERCENT,
        upper * 100 > F.char_length(text) * MAX_UPPER_PERCENT,
        text.rlike(SYMBOLS),
    ]
    bits = [F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)]
    return sum(bits[1:], bits[0]).cast("int")


def _label_flags(labels: DataFrame, id_col: str) -> DataFrame:
    """One row per labelled id; a flag is set if any of its rows says so."""
    found = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
    return found.agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"),
    )


class FilterAudit:
    """Counters and text state of one audit below `path`; each finished epoch has a folder in both."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _earlier(self, kind: str, schema: str, epoch: int | None = None) -> DataFrame:
        names = [n for n in list_names(self.spark, f"{self.path}/{kind}") if epoch is None or n < f"{epoch:09d}"]
        if not names:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}/{n}" for n in names])

    def _write(self, rows: DataFrame, kind: str, epoch: int) -> DataFrame:
        path = f"{self.path}/{kind}/{epoch:09d}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def take(self, judged: DataFrame, epoch: int, flags: DataFrame) -> None:
        """One micro-batch of (id, part, mask, digest): change the counters, then the state."""
        judged = judged.join(flags, "id", "left").na.fill(False, ["good", "toxic"])
        kind = ["digest", *_KIND]
        # Rows that repeat an id are added up first; the id spreads a hot text over all tasks.
        seen = judged.groupBy(*kind, "id").agg(F.count("*").alias("n"))
        groups = seen.groupBy(*kind).agg(
            F.sum("n").alias("n"), F.min("id").alias("id"),
            F.coalesce(F.min_by("n", "id"), F.lit(0)).alias("holders"),
            F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("without_id"),
        )
        groups = self._write(groups, "arrived", epoch)
        state = self._earlier("state", _STATE, epoch)
        if epoch:
            state = store(state.join(groups.select("digest"), "digest", "left_semi"), "touched")
        least = groups.select("digest", "id", F.lit(None).cast("long").alias("before"))
        least = least.unionByName(state.select("digest", F.lit(None).cast("long").alias("id"), F.col("id").alias("before")))
        least = least.groupBy("digest").agg(F.least(F.min("id"), F.min("before")).alias("least"), F.min("before").alias("before"))
        least = store(least, "least")

        placed = groups.join(least, "digest")
        first = F.when(F.col("id") == F.col("least"), F.col("holders")).otherwise(0) + F.col("without_id")
        changes = placed.select(*_KIND, "n", first.alias("first"))
        old = state.join(least.where("least < before"), "digest").where("id = before")
        retracted = old.select(*_KIND, F.lit(0).cast("long").alias("n"), (-F.col("holders")).alias("first"))
        changes = changes.unionByName(retracted)
        # `n` documents arrived, `first` of them have no smaller twin; a retraction moves some from first to repeated.
        both = F.array(
            F.struct(F.col("mask").alias("mask"), F.col("first").alias("n")),
            F.struct((F.col("mask") + REPEATED).alias("mask"), (F.col("n") - F.col("first")).alias("n")),
        )
        moved = changes.select("part", "good", "toxic", F.explode(both).alias("x")).select("part", "x.mask", "good", "toxic", "x.n")
        self._write(moved.groupBy(*_KIND).agg(F.sum("n").alias("n")).where("n <> 0"), "counters", epoch)
        lowered = placed.where("id = least").select("digest", *_KIND, "id", "holders")
        self._write(lowered, "state", epoch)

    def counters(self) -> DataFrame:
        """Documents per part, mask, good and toxic, over all epochs."""
        return self._earlier("counters", _CHANGES).groupBy(*_KIND).agg(F.sum("n").alias("n")).where("n <> 0")


def run_audit(
    spark: SparkSession, documents: str, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "source", rounds: int = ROUNDS, path: str | None = None,
) -> FilterAudit:
    """Feed all Parquet files at `documents` to an audit below `path`, in about `rounds` micro-batches.

    With a `path` used before, only files that arrived since are read.
    """
    path = path or scratch_dir(spark, "filter-audit")
    table = spark.read.parquet(documents)
    files = table.inputFiles()  # a file stream lists its files on the driver, too
    per_round = max(-(-len(files) // rounds), 1)
    if len(files) == 1 and files[0].endswith(documents.rsplit("/", 1)[-1]):
        documents = f"{documents[:-1]}[{documents[-1]}]"  # streams take a folder or a pattern, not a single file
    audit = FilterAudit(spark, path)
    flags = store(_label_flags(labels, id_col), "labels")
    text = F.coalesce(F.col("text"), F.lit(""))
    stream = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", per_round).parquet(documents)
    narrow = stream.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).alias("text"),
    )
    judged = narrow.select("id", "part", mask(text).alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    query = (
        judged.writeStream.foreachBatch(lambda rows, epoch: audit.take(rows, epoch, flags))
        .option("checkpointLocation", f"{path}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return audit


def interactions(counters: DataFrame) -> DataFrame:
    """One row per part, order and step, from counters (part, mask, good, toxic, n).

    kept and removed after and by this step, redundant (fails it, but was removed before), unique_fails (fails only it), good_lost and
    toxic_lost among the removed, and shapley: the filter's removed over all orders.  A part has at most 32 masks, so a row
    of the part holds them all.
    """
    per_mask = counters.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )
    parts = per_mask.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    steps = F.array(*[
        F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(e).alias("before"))
        for o, s, b, e in STEPS
    ])
    rows = parts.select("part", "masks", F.explode(steps).alias("at")).select("part", "masks", "at.*")
    bit, before = F.col("bit"), F.col("before")

    def total(value, where) -> Column:
        zero = F.lit(0).cast("long")
        return F.aggregate("masks", zero, lambda acc, m: acc + F.when(where(m["mask"]), value(m)).otherwise(zero))

    def fails(m):
        return m.bitwiseAND(bit) != 0

    def left(m):
        return m.bitwiseAND(before) == 0

    def count(m):
        return m["n"]

    # Of the k filters that a document fails, each comes first in 120 / k orders.
    first_in = F.lit(len(ORDERS))
    share = total(lambda m: m["n"] * (first_in / F.bit_count(m["mask"])).cast("long"), fails)
    return rows.select(
        "part", "filter_order", "step",
        total(count, lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(count, lambda m: fails(m) & left(m)).alias("removed"),
        total(count, lambda m: fails(m) & ~left(m)).alias("redundant"),
        total(count, lambda m: m == bit).alias("unique_fails"),
        total(lambda m: m["good"], lambda m: fails(m) & left(m)).alias("good_lost"),
        total(lambda m: m["toxic"], lambda m: fails(m) & left(m)).alias("toxic_lost"),
        share.alias("shapley"),
    )


def filter_audit(spark: SparkSession, documents: str, labels: DataFrame, **options) -> DataFrame:
    """The interactions of all files at `documents`.

    Null and empty texts are equal: they fail A only (and E from the second on).  A null part is the empty part.  Rows without
    an id never fail E and make nobody else fail it; rows that repeat the smallest id of a text all pass it.
    Rows without labels count as neither good nor toxic, an id with several label rows as what any of them says.
    Very long texts are judged whole.  Other columns are not read.  An empty table gives no rows.
    """
    return interactions(run_audit(spark, documents, labels, **options).counters())


def oracle_query() -> str:
    """The interactions as DuckDB SQL."""
    values = ", ".join(f"('{o}', {s}, {b}, {e})" for o, s, b, e in STEPS)
    split = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
    return f"""
WITH l AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {split} AS ws FROM d),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
  (CASE WHEN len(ws) < {MIN_WORDS} THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(ws)) < {MIN_DISTINCT_PERCENT} * len(ws) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > {MAX_UPPER_PERCENT} * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '{SYMBOLS}') THEN 8 ELSE 0 END
  + CASE WHEN coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) THEN {REPEATED} ELSE 0 END)::INT AS mask
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
s(filter_order, step, b, e) AS (VALUES {values}),
x AS (SELECT part, filter_order, step, b, count(*) FILTER (mask & (b | e) = 0) AS kept,
  count(*) FILTER (mask & b <> 0 AND mask & e = 0) AS removed,
  count(*) FILTER (mask & b <> 0 AND mask & e <> 0) AS redundant, count(*) FILTER (mask = b) AS unique_fails,
  count(*) FILTER (good AND mask & b <> 0 AND mask & e = 0) AS good_lost,
  count(*) FILTER (toxic AND mask & b <> 0 AND mask & e = 0) AS toxic_lost FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, b))::BIGINT AS shapley FROM x"""
