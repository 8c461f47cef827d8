"""Exact duplicates through a persistent digest index, bucketed and sorted by hash.

A delivery is cut into slices by falling id.  Each slice is reduced to one row per digest, anti-joined with the index by
a sort-merge join that reads the index in its buckets without shuffling it, and what is new is appended.  So
the anti-join decides which row of a text stays: the one that was there first, and within a delivery the one with the
largest id.
"""

from __future__ import annotations

import uuid
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm.graph import store
from sluiceway.llm.skew import attach
from sluiceway.llm.text import ROW, lower_ascii, wrapped
from sluiceway.session import fits_broadcast, list_names, scratch_dir

TEXTS_PER_BUCKET = 5_000_000  # some 400 MB of digests, ids and delivery names
LEAST_BUCKETS = 24
SLICES = 3


def digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, as bytes; null counts as empty."""
    return F.unhex(F.sha2(lower_ascii(text).cast("binary"), 256))


class DigestIndex:
    """Digests of all texts delivered so far, with the id that stays and the delivery it came by, below `path`.

    The number of buckets follows from the size of the first delivery, unless given, and stays with the index; `rebucket` deals it
    anew once it has outgrown them.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark, self.path, self.buckets, self.table = spark, path, buckets, None
        layouts = list_names(spark, f"{path}/layout")
        if layouts:
            self._open(*map(int, layouts[-1].split("-")))

    def _open(self, generation: int, buckets: int) -> None:
        self.close()
        self.generation, self.buckets, self.table = generation, buckets, f"digest_index_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, delivery STRING) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}/digests-{generation}'"
        )

    def _show(self, generation: int, buckets: int) -> None:
        self.spark.range(1).write.mode("overwrite").parquet(f"{self.path}/layout/{generation:06d}-{buckets}")

    def close(self) -> None:
        """Take the name out of the catalog; the files stay."""
        if self.table:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            self.table = None

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def _append(self, rows: DataFrame) -> None:
        (
            rows.select("digest", "keep_id", "delivery").repartition(self.buckets, "digest")
            .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)
        )

    def rebucket(self, buckets: int) -> None:
        """Deal the index to another number of buckets; the old files count until all new ones are written."""
        rows, generation = self.read(), self.generation + 1
        old = self.table
        self.table = None
        self._open(generation, buckets)
        self._append(rows)
        self._show(generation, buckets)
        self.spark.sql(f"DROP TABLE IF EXISTS {old}")

    def _take(self, ids: DataFrame, delivery: str) -> None:
        """One slice: append the digests that the index does not hold."""
        groups = ids.groupBy("digest").agg(F.max("id").alias("keep_id"))
        new = groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        self._append(store(new.withColumn("delivery", F.lit(delivery)), "new"))

    def add(
        self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", delivery: str | None = None, slices: int = SLICES
    ) -> DataFrame:
        """Deliver `docs`; per row: id, digest, keep_id, group_size, kept.  New texts are in the index afterwards.

        Of equal texts of one delivery the row with the largest id stays; a text known from another
        delivery stays there.  Null and empty texts are equal, very long ones are digested whole.  Rows that repeat both id
        and text stay or go together.  Null ids never win over others; a text that only rows without id have keeps those.
        An empty delivery changes nothing.  Other columns are not read.

        A delivery that broke off at any point can be repeated under its name: digests it had already
        added bear that name, and since its largest ids went first, the right rows stay.
        """
        delivery = delivery or uuid.uuid4().hex
        ids = docs.select(F.col(id_col).cast("long").alias("id"), digest(F.col(text_col)).alias("digest"))
        ids = store(ids, "digests")
        if self.table is None:
            if self.buckets is None:
                self.buckets = max(LEAST_BUCKETS, ceil(ids.count() / TEXTS_PER_BUCKET))
            self._show(0, self.buckets)
            self._open(0, self.buckets)
        parts = [k / slices for k in range(slices - 1, 0, -1)]
        cuts = ids.agg(F.percentile_approx("id", F.array(*map(F.lit, parts)), 1000)).first()[0] if parts else []
        above = None
        for cut in sorted(set(cuts or []), reverse=True):
            self._take(ids.where(F.col("id") > cut).where(F.col("id") <= above if above is not None else F.lit(True)), delivery)
            above = cut
        self._take(ids if above is None else ids.where(f"id IS NULL OR id <= {above}"), delivery)

        sizes = ids.groupBy("digest").agg(F.count("*").alias("group_size"))
        known = sizes.join(self.read().hint("merge"), "digest")
        # Texts that occur once and came by this delivery need no look-up.
        known = known.withColumn("early", F.col("delivery") != delivery).drop("delivery").where("group_size > 1 OR early")
        found = attach(ids, store(known, "known"), "digest", "group_size", 64)
        keep = F.when(F.col("group_size").isNotNull(), F.col("keep_id")).otherwise(F.col("id"))
        return found.select(
            F.col("id").alias(id_col), "digest", keep.alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
            (~F.coalesce("early", F.lit(False)) & keep.eqNullSafe(F.col("id"))).alias("kept"),
        )


def drop_exact_duplicates(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", delivery: str | None = None
) -> DataFrame:
    """Deliver `docs` to the index and return the rows that stay; columns unchanged, whatever their names.

    Nulls, empty and long texts, ties, repeated rows, an empty table and a repeated `delivery` are treated as in `DigestIndex.add`.
    """
    gone = index.add(docs, id_col, text_col, delivery).where("NOT kept").select(F.col(id_col).alias("gone_id"), "digest")
    gone = store(gone.distinct(), "gone")
    if fits_broadcast(gone.count(), 40):
        gone = F.broadcast(gone)
    rows = wrapped(docs, id=F.col(id_col), own=digest(F.col(text_col)))
    same = rows["id"].eqNullSafe(F.col("gone_id")) & (rows["own"] == F.col("digest"))
    return rows.join(gone, same, "left_anti").select(f"{ROW}.*")


def fresh_index(spark: SparkSession) -> DigestIndex:
    """An empty index in the shared folder."""
    return DigestIndex(spark, scratch_dir(spark, "digest-index"))
