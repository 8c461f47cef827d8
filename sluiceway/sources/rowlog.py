"""Append-only rows of one schema that can be rewritten without a moment at which they are gone.

Every append is a folder of its own below `rows`.  A rewrite stores the remaining rows below `base` and then adds one
entry to `heads` that names this base and the appended folders it covers.  That entry is the only step a reader notices:
before it the old base and folders count, after it the new ones.  What a rewrite replaced is deleted by the
next one, so a reader that has just listed the folders still finds them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sluiceway.session import delete_path, list_names

HEAD_SCHEMA = "base string, covers array<string>"
COMPACT_EVERY = 64
ROWS_PER_FILE = 1_000_000


class RowLog:
    _seen: dict[str, tuple[str, list[str]]] = {}  # finished heads, which never change

    def __init__(self, spark: SparkSession, path: str, schema: str | StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _head(self, names: list[str]) -> tuple[str | None, list[str]]:
        """Base and covered folders of the newest finished head; a head that died half way holds no row."""
        for name in reversed(names):
            path = f"{self.path}/heads/{name}"
            if path not in RowLog._seen:
                row = self.spark.read.schema(HEAD_SCHEMA).parquet(path).first()
                if not row:
                    continue
                RowLog._seen[path] = row.base, list(row.covers)
            return RowLog._seen[path]
        return None, []

    def _names(self, kind: str) -> list[str]:
        return list_names(self.spark, f"{self.path}/{kind}")

    def state(self) -> tuple[str, ...]:
        """What the content depends on: equal states mean equal rows."""
        return (*self._names("heads"), *self._names("rows"))

    def _folders(self) -> tuple[list[str], list[str]]:
        """Folders to read, and the appended ones among them."""
        # Rows first: what a head covers may be deleted, but never what was listed before it.
        appended = self._names("rows")
        base, covers = self._head(self._names("heads"))
        fresh = sorted(set(appended) - set(covers))
        return ([f"{self.path}/base/{base}"] if base else []) + [f"{self.path}/rows/{n}" for n in fresh], fresh

    def read(self) -> DataFrame:
        folders, _ = self._folders()
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def append(self, rows: DataFrame, one_file: bool = True) -> None:
        """Add rows of the log's schema; a few at a time go to one file."""
        (rows.coalesce(1) if one_file else rows).write.parquet(f"{self.path}/rows/{uuid.uuid4().hex}")
        if len(self._folders()[1]) >= COMPACT_EVERY:
            self.compact()

    def compact(self) -> None:
        self.rewrite(lambda rows: rows)

    def rewrite(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """Replace all rows by `change` of them.  Killed at any point, either the old or the new rows are there."""
        appended, heads = self._names("rows"), self._names("heads")
        before, covered = self._head(heads)
        folders = [f"{self.path}/base/{before}"] if before else []
        folders += [f"{self.path}/rows/{n}" for n in appended if n not in covered]
        if not folders:
            return
        base = uuid.uuid4().hex
        kept = change(self.spark.read.schema(self.schema).parquet(*folders))
        kept.repartition(max(ceil(kept.count() / ROWS_PER_FILE), 1)).write.parquet(f"{self.path}/base/{base}")
        self._show(base, appended, heads)
        self._clean(covered, {before, base}, heads)

    def _show(self, base: str, covers: list[str], heads: list[str]) -> None:
        seq = max((int(n) for n in heads), default=0) + 1
        entry = self.spark.createDataFrame([(base, covers)], HEAD_SCHEMA)
        entry.coalesce(1).write.parquet(f"{self.path}/heads/{seq:012d}")

    def _clean(self, covered: list[str], keep: set[str | None], heads: list[str]) -> None:
        """Forget what neither the new head nor the one before it reads."""
        for name in covered:
            delete_path(self.spark, f"{self.path}/rows/{name}")
        for name in set(self._names("base")) - keep:
            delete_path(self.spark, f"{self.path}/base/{name}")
        for name in heads[:-1]:
            delete_path(self.spark, f"{self.path}/heads/{name}")
