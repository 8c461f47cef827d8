"""The tables of one deployment: mirror, staging, mart, references and audit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.functions.scalars import hash_sums
from sluiceway.operators.audit import AuditLog
from sluiceway.operators.upsert import forget_merge
from sluiceway.plans.ledger import FAILED, LOADED, PASSED, Delivery, Ledger
from sluiceway.plans.transactions import MART_COLUMNS, MART_SCHEMA, STAGING_SCHEMA, openings, with_openings
from sluiceway.session import delete_path, list_names
from sluiceway.sources.mirror import open_mirror
from sluiceway.sources.tables import Facts, PartTable

MONTH = "_MONTH"
# A note of a merge: the version and parts that came in, or the month of a row that was replaced, with its key.
CHANGE_SCHEMA = "version string, part string, TXN_ID string, TXN_DATE date"


def facts() -> Facts:
    """What the third gate compares, and what the months of the mart open with."""
    key = F.col("TXN_ID")
    sums = {
        "amount": F.col("AMOUNT"),
        # The sums of two hashes tell tables of different keys apart without comparing the keys.
        **hash_sums("keys", F.xxhash64(key)),
        **hash_sums("more_keys", F.xxhash64(F.lit("again"), key)),
    }
    return Facts(("ACCOUNT_ID", "CURRENCY"), sums, {"latest": F.col("_LOADED_AT")})


@dataclass(frozen=True)
class Store:
    """Mirror and staging are split by batch, the mart by the month of the transaction.

    A gate therefore reads one part of the first two.  In the mart a position counts from the beginning of the
    month; the months' openings follow from the facts of its parts and are added on reading.  So a refresh
    rewrites the months of changed rows and no later ones, and batches of recent days touch one or two.
    """

    spark: SparkSession
    root: str
    accounts: DataFrame
    instruments: DataFrame

    @property
    def mirror(self) -> PartTable:
        return open_mirror(self.spark, f"{self.root}/mirror", key="TXN_ID")

    @property
    def staging(self) -> PartTable:
        return PartTable(self.spark, f"{self.root}/staging", STAGING_SCHEMA, part="_BATCH_ID", facts=facts(), key=F.col("TXN_ID"))

    @property
    def mart(self) -> PartTable:
        stored = StructType([*MART_SCHEMA.fields, StructField(MONTH, StringType())])
        return PartTable(self.spark, f"{self.root}/mart", stored, part=MONTH, facts=facts())

    @property
    def audit(self) -> AuditLog:
        return AuditLog(self.spark, f"{self.root}/audit")

    # ---- deliveries, and what the mart still has to take over --------------

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger")

    def deliveries(self, batch: str | None = None) -> list[Delivery]:
        """(batch, version) of everything the mirror shows; one entry per delivery."""
        live = self.mirror.live_parts()
        return sorted((b, v) for b, versions in live.items() if batch in (None, b) for v in versions)

    def waiting(self, *states: str) -> list[Delivery]:
        """Deliveries in one of the states."""
        return self.ledger.among(self.deliveries(), *states)

    def approve(self, batch: str) -> list[Delivery]:
        """Let the deliveries of a batch pass that no gate has judged yet or that one has stopped."""
        return self.ledger.record(self.ledger.among(self.deliveries(batch), LOADED, FAILED), PASSED)

    def note_change(self, version: str, parts: list[str], replaced: DataFrame) -> None:
        """Keep what a merge is about to change in staging: its version and parts, and (TXN_ID, TXN_DATE) of replaced rows.

        The note bears the number the merge will have in staging's log, so a merge that never came to show
        is told from one the mart has not taken over.
        """
        path = f"{self.root}/changes/{self.staging.next_seq():012d}"
        came = self.spark.createDataFrame([(version, p, None, None) for p in parts], CHANGE_SCHEMA)
        none = F.lit(None).cast("string")
        gone = replaced.select(none.alias("version"), none.alias("part"), "TXN_ID", "TXN_DATE")
        came.unionByName(gone).write.mode("overwrite").parquet(path)

    def open_changes(self) -> list[str]:
        """Notes of merges that show in staging and not yet in the mart; a few at most."""
        shown = f"{self.staging.next_seq():012d}"
        return [n for n in list_names(self.spark, f"{self.root}/changes") if n < shown]

    def changes(self, notes: list[str]) -> DataFrame:
        return self.spark.read.schema(CHANGE_SCHEMA).parquet(*[f"{self.root}/changes/{n}" for n in notes])

    def forget_changes(self, notes: list[str]) -> None:
        """Delete notes the mart has taken over, and what their merges had looked up."""
        if notes:
            for row in self.changes(notes).where("version IS NOT NULL").select("version").distinct().collect():
                forget_merge(self.staging, row.version)
        for name in notes:
            delete_path(self.spark, f"{self.root}/changes/{name}")

    def mart_rows(self) -> DataFrame:
        """The mart with positions over all months."""
        totals = self.mart.read_facts().select("ACCOUNT_ID", F.to_date("part").alias("TXN_MONTH"), "amount")
        return with_openings(self.mart.read().select(*MART_COLUMNS), openings(totals))

    def vacuum(self) -> None:
        """Delete what nothing shows or needs any more; only while nobody reads or writes."""
        notes = self.open_changes()
        noted = [r.version for r in self.changes(notes).where("version IS NOT NULL").select("version").distinct().collect()] if notes else []
        for table, keep in ((self.mirror, []), (self.staging, noted), (self.mart, [])):
            table.vacuum(keep)
