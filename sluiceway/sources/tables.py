"""Partitioned Parquet tables whose partitions are replaced as a whole.

Rows are written under a fresh version folder by one job; a second, one-file
append to the log then makes them visible.  A job that dies in between leaves
files nobody reads, so a batch is seen entirely or not at all and can be retried.
Earlier versions stay on disk until `vacuum`, which keeps running readers valid.

Every few publishes a snapshot of what is shown replaces the log before it, so reading the log
costs what is live now, not what ever happened.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluiceway.session import delete_path, list_names, scoped_conf
from sluiceway.sources.rowlog import RowLog
from sluiceway.sources.sketches import BLOCK_COLUMNS, groups_that_may_hold, key_filters, together

VERSION = "_VERSION"
# Timestamps as plain integers: smaller, and with the statistics that let a scan skip row groups.
WRITE_SETTINGS = {"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"}
# What a log entry does to a part: `show` makes the version its only one, `add` one more, `drop` hides
# the version, or all if none is named.  `stale` keeps note of a part that a still-used version also wrote.
LOG_SCHEMA = "seq bigint, op string, part string, version string, item string, rows bigint"
SNAPSHOT_EVERY = 20
_NAMED_PAIRS = 500  # up to so many versions, and parts of them that no longer show, are named in the plan instead of joined


class SchemaChanged(Exception):
    """Incoming columns or types differ from the table's."""


def require_same_schema(expected: StructType, actual: StructType) -> None:
    """Fail if names or types differ; order and nullability do not matter."""
    want = {f.name: f.dataType for f in expected}
    have = {f.name: f.dataType for f in actual}
    if want != have:
        gone, new = sorted(want.keys() - have.keys()), sorted(have.keys() - want.keys())
        moved = sorted(n for n in want.keys() & have.keys() if want[n] != have[n])
        raise SchemaChanged(f"missing={gone} unexpected={new} retyped={moved}")


class Facts(NamedTuple):
    """Statistics that add up: per part, version and members of `by`, the row count and the given sums and maxima."""

    by: tuple[str, ...]
    sums: dict[str, Column]
    maxima: dict[str, Column]

    def of(self, rows: DataFrame, *groups: Column) -> DataFrame:
        found = [F.sum(c).alias(n) for n, c in self.sums.items()] + [F.max(c).alias(n) for n, c in self.maxima.items()]
        return rows.groupBy(*groups, *self.by).agg(F.count(F.lit(1)).alias("rows"), *found)

    def folded(self, facts: DataFrame, *groups: str) -> DataFrame:
        """Facts over fewer groups."""
        found = [F.sum(n).alias(n) for n in ["rows", *self.sums]] + [F.max(n).alias(n) for n in self.maxima]
        return facts.groupBy(*groups).agg(*found)


class PartTable:
    """A table split by one column; `item` optionally names what a part was loaded from.

    With `facts`, each publish also counts these over the rows it shows, as they were written, and `read_facts` puts
    them together, so that totals of the whole table cost a look at a few rows per part.

    With `key`, each publish also stores a filter over the keys of every part it shows, and `may_hold` names the parts
    in which given keys can be; the others need not be read, in whatever order keys come.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        part: str,
        item: str | None = None,
        facts: Facts | None = None,
        key: Column | None = None,
    ):
        self.spark, self.path, self.schema, self.part, self.item = spark, path.rstrip("/"), schema, part, item
        self.facts, self.key = facts, key
        self._data, self._log, self._filters = f"{self.path}/data", f"{self.path}/log", f"{self.path}/filters"
        self._stored = StructType([*schema.fields, StructField(VERSION, StringType())])

    # Per path: the log folders read last, and what they say.  Folders are written once, so it holds while they are the same.
    _known: dict[str, tuple[list[str], tuple]] = {}

    # ---- reading ---------------------------------------------------------

    def _log_folders(self) -> list[str]:
        snapshots, entries = list_names(self.spark, f"{self.path}/snapshot"), list_names(self.spark, self._log)
        last = max(snapshots, default="")
        folders = [f"{self.path}/snapshot/{last}"] if last else []
        return folders + [f"{self._log}/{e}" for e in entries if e > last]

    def log(self) -> DataFrame:
        """Entries since the latest snapshot, and the snapshot itself."""
        folders = self._log_folders()
        if not folders:
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(*folders)

    def next_seq(self) -> int:
        """The number the next publish will have."""
        names = list_names(self.spark, f"{self.path}/snapshot") + list_names(self.spark, self._log)
        return max((int(n) for n in names), default=0) + 1

    def _state(self) -> tuple[dict[str, list[str]], dict[str, set[str]]]:
        """Versions each part shows, and the parts each version wrote.

        One entry per live part and per part a live version wrote, however long the table has existed.  Read anew
        only when something was published.
        """
        folders = self._log_folders()
        known = PartTable._known.get(self.path)
        if known is None or known[0] != folders:
            known = PartTable._known[self.path] = folders, self._replayed()
        live, written = known[1]
        return {part: list(versions) for part, versions in live.items()}, {v: set(parts) for v, parts in written.items()}

    def _replayed(self) -> tuple[dict[str, list[str]], dict[str, set[str]]]:
        seen = self.log().select("seq", "op", "part", "version").distinct()
        live: dict[str, list[str]] = {}
        written: dict[str, set[str]] = {}
        # Of one publish, parts are emptied before versions are shown.
        for r in sorted(seen.collect(), key=lambda r: (r.seq, r.op != "drop", r.version or "")):
            if r.op == "drop":
                live[r.part] = [v for v in live.get(r.part, []) if r.version is not None and v != r.version]
                continue
            written.setdefault(r.version, set()).add(r.part)
            if r.op == "show":
                live[r.part] = [r.version]
            elif r.op == "add":
                live.setdefault(r.part, []).append(r.version)
        return {part: versions for part, versions in live.items() if versions}, written

    def live_parts(self) -> dict[str, list[str]]:
        """Part -> versions it currently shows."""
        return self._state()[0]

    def _shown(self, rows: DataFrame) -> DataFrame:
        """Those of some (part, version) rows that the table shows."""
        live, written = self._state()
        pairs = [(part, v) for part, versions in live.items() for v in versions if part is not None]
        part, version, shown = F.col("part"), F.col("version"), {v for _, v in pairs}
        stale = {v: sorted(p for p in written[v] - {part for part, used in pairs if used == v} if p is not None) for v in shown}
        if len(shown) + sum(map(len, stale.values())) > _NAMED_PAIRS:
            return rows.join(self.spark.createDataFrame(pairs, "part string, version string"), ["part", "version"], "left_semi")
        # Versions as they stand, less the parts that a later version replaced: facts are many, so nothing is computed from a row.
        rows = rows.where(version.isin(sorted(shown)) & part.isNotNull())
        for v in sorted(shown):
            if stale[v]:
                rows = rows.where((version != v) | ~part.isin(stale[v]))
        return rows

    def _live_entries(self) -> DataFrame:
        """Log entries of what is shown."""
        return self._shown(self.log().where("op IN ('show', 'add')"))

    def _fact_log(self) -> RowLog:
        part, version = F.col(self.part).cast("string").alias("part"), F.col(VERSION).alias("version")
        shape = self.facts.of(self.spark.createDataFrame([], self._stored), part, version).schema
        return RowLog(self.spark, f"{self.path}/facts", shape)

    def read_facts(self) -> DataFrame:
        """The facts of all rows shown: part, version, members, rows, sums and maxima."""
        return self._shown(self._fact_log().read())

    def may_hold(self, keys: DataFrame, rows: int) -> set[tuple[str, str]]:
        """The (part, version) pairs shown that may hold one of the keys, the only column of `keys`, of at most `rows` rows.

        Pairs without a filter are among them: versions published before the table had a key, and versions without any.
        """
        live = {(part, v) for part, versions in self.live_parts().items() for v in versions}
        stored = {name.split("=", 1)[1] for name in list_names(self.spark, self._filters)}
        asked = sorted({v for _, v in live} & stored)
        unknown = {pair for pair in live if pair[1] not in stored}
        if not asked:
            return unknown
        source = self.spark.read.schema(f"{BLOCK_COLUMNS}, `{VERSION}` string, `{self.part}` string").option("basePath", self._filters)
        filters = source.parquet(*[f"{self._filters}/{VERSION}={v}" for v in asked])
        found = groups_that_may_hold(filters, [self.part, VERSION], keys, rows)
        return unknown | ({(r[0], r[1]) for r in found.collect()} & live)

    def items(self) -> DataFrame:
        """What has been loaded: item, part, version and row count."""
        return self._live_entries().select("item", "part", "rows", "version")

    def is_empty(self) -> bool:
        return not self.live_parts()

    def read(self, only: Collection[tuple[str, str]] | None = None) -> DataFrame:
        """Current rows, if wanted `only` those of some (part, version) pairs.

        Columns added to the schema later are NULL in older files.
        """
        live, written = self._state()
        shown: dict[str, set[str]] = {}
        for part, versions in live.items():
            for version in versions:
                if only is None or (part, version) in only:
                    shown.setdefault(version, set()).add(part)
        if not shown:
            return self.spark.createDataFrame([], self.schema)
        rows = self.stored(*shown)
        for version, parts in shown.items():
            # Parts of a still-used folder that a later version replaced.
            stale = sorted(written[version] - parts)
            if stale:
                rows = rows.where(~((F.col(VERSION) == version) & F.col(self.part).isin(stale)))
        return rows.select(self.schema.names)

    # ---- writing ---------------------------------------------------------

    def write(self, rows: DataFrame, spread: bool = False) -> str:
        """Store rows under a new version that nobody sees yet.

        `spread` gathers rows by part before writing, for rows that come from many
        parts at once; Spark splits a part that is too large for one task.
        """
        require_same_schema(self.schema, rows.schema)
        version = uuid.uuid4().hex
        out = rows.select(self.schema.names)
        if spread:
            out = out.hint("rebalance", self.part)
        with scoped_conf(self.spark, WRITE_SETTINGS):
            out.write.partitionBy(self.part).parquet(self._folder(version))
        return version

    def stored(self, *versions: str) -> DataFrame:
        """Rows of the given versions, published or not."""
        source = self.spark.read.schema(self._stored).option("basePath", self._data)
        return source.parquet(*[self._folder(v) for v in versions])

    def publish(
        self,
        versions: Iterable[str],
        drop: Iterable[str] = (),
        hide: Iterable[tuple[str, str]] = (),
        op: str = "show",
        given: DataFrame | None = None,
        check: Callable[[DataFrame], None] | None = None,
    ) -> None:
        """Show the versions' parts, by appending one log entry; empty `drop` parts, hide `hide` (part, version) pairs.

        A part that is dropped and written at once ends up written.  `given` (part, version, item) names
        items to be logged even if they hold no row.  `check` gets (part, version, item, rows) of what was
        written and may raise to keep it out.
        """
        seq, versions = self.next_seq(), list(versions)
        item = F.col(self.item) if self.item else F.lit(None).cast("string")
        keys = [F.col(self.part).alias("part"), F.col(VERSION).alias("version"), item.alias("item")]
        if self.facts:
            entries = self._add_facts(versions, keys)
        else:
            entries = self.stored(*versions).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        if check:
            path = f"{self.path}/counted/{seq:012d}-{uuid.uuid4().hex}"
            entries.write.parquet(path)
            entries = self.spark.read.schema(entries.schema).parquet(path)
            check(entries)
        if self.key is not None:
            self._add_filters(versions, entries)
        if given is not None:
            zero = given.select("part", "version", "item", F.lit(0).cast("bigint").alias("rows"))
            entries = entries.unionByName(zero).groupBy("part", "version", "item").agg(F.sum("rows").alias("rows"))
        stamp = F.lit(seq).cast("bigint").alias("seq")
        entries = entries.select(stamp, F.lit(op).alias("op"), "part", "version", "item", "rows")
        emptied = [(seq, "drop", part, None, None, 0) for part in drop]
        emptied += [(seq, "drop", part, version, None, 0) for part, version in hide]
        if emptied:
            entries = entries.unionByName(self.spark.createDataFrame(emptied, LOG_SCHEMA))
        # One file, gathered after the counting.
        entries.repartition(1).write.parquet(f"{self._log}/{seq:012d}")
        if check:
            delete_path(self.spark, path)
        if seq % SNAPSHOT_EVERY == 0:
            self.snapshot(seq)

    def _add_filters(self, versions: list[str], entries: DataFrame) -> None:
        """Store the key filters of versions about to show; a repeated publish adds the same blocks once more."""
        groups = [self.part, VERSION]
        sizes = entries.groupBy(F.col("part").alias(self.part), F.col("version").alias(VERSION)).agg(F.sum("rows").alias("rows"))
        blocks = key_filters(self.stored(*versions), self.key, groups, sizes)
        together(blocks, groups).write.mode("append").partitionBy(VERSION, self.part).parquet(self._filters)

    def _add_facts(self, versions: list[str], keys: list[Column]) -> DataFrame:
        """Count and store the facts of versions about to show; returns their log entries."""
        log = self._fact_log()
        rows = self.stored(*versions)
        log.append(self.facts.of(rows, keys[0], keys[1]).select(log.schema.names), one_file=False)
        mine = log.read().where(F.col("version").isin(versions))
        counted = mine.groupBy("part", "version").agg(F.sum("rows").alias("rows"))
        return counted.select("part", "version", F.lit(None).cast("string").alias("item"), "rows")

    def snapshot(self, seq: int | None = None) -> None:
        """Write what is shown as one log entry and forget the entries before the previous snapshot."""
        seq = seq if seq is not None else self.next_seq()
        live, written = self._state()
        shown = {(part, v) for part, versions in live.items() for v in versions}
        used = {v for _, v in shown}
        stale = [(seq, "stale", part, v, None, 0) for v in used for part in written[v] if (part, v) not in shown]
        entries = self._live_entries().select(
            F.lit(seq).cast("bigint").alias("seq"), F.lit("add").alias("op"), "part", "version", "item", "rows"
        )
        if stale:
            entries = entries.unionByName(self.spark.createDataFrame(stale, LOG_SCHEMA))
        before = max(list_names(self.spark, f"{self.path}/snapshot"), default="")
        entries.repartition(1).write.parquet(f"{self.path}/snapshot/{seq:012d}")
        if self.facts:
            self._fact_log().rewrite(self._shown)
        # Readers may still hold the previous snapshot and what follows it.
        for kind in ("snapshot", "log"):
            for name in list_names(self.spark, f"{self.path}/{kind}"):
                if name < before:
                    delete_path(self.spark, f"{self.path}/{kind}/{name}")

    def vacuum(self, keep: Iterable[str] = ()) -> list[str]:
        """Delete version folders that nothing shows, but for `keep`; only while no reader or writer is at work."""
        used = {v for versions in self.live_parts().values() for v in versions} | set(keep)
        gone = [n for n in list_names(self.spark, self._data) if n.split("=")[-1] not in used]
        for name in gone:
            delete_path(self.spark, f"{self._filters}/{name}")
            delete_path(self.spark, f"{self._data}/{name}")
        return gone

    def replace(
        self,
        rows: DataFrame,
        drop: Iterable[str] = (),
        spread: bool = False,
        verify: Callable[[], None] | None = None,
    ) -> str:
        """Make `rows` the whole content of every part they contain; `drop` empties parts.

        `verify` runs between writing and publishing and may raise to keep the rows out.
        """
        version = self.write(rows, spread)
        if verify:
            verify()
        self.publish([version], drop)
        return version

    def forget(self, version: str) -> None:
        """Delete a version that was written and never shown."""
        delete_path(self.spark, self._folder(version))

    def _folder(self, version: str) -> str:
        return f"{self._data}/{VERSION}={version}"

    def delete_where(self, condition) -> list[str]:
        """Remove matching rows; only the parts that hold one are rewritten."""
        rows = self.read()
        hit = [r[0] for r in rows.where(condition).select(self.part).distinct().collect()]
        if hit:
            kept = rows.where(F.col(self.part).isin(hit)).where(~F.coalesce(condition, F.lit(False)))
            self.replace(kept, drop=hit, spread=True)
        return hit

    def seed(self, rows: DataFrame) -> bool:
        """Insert only if the table holds nothing yet."""
        if not self.is_empty():
            return False
        self.replace(rows)
        return True
