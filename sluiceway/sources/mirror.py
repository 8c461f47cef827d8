"""The mirror: one semi-structured payload column plus lineage and technical columns."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
    VariantType,
)

from sluiceway.functions.payload import value_of
from sluiceway.functions.scalars import key_hash
from sluiceway.sources.tables import PartTable

# The mirror's 22 columns, in order.
MIRROR_COLUMNS = [
    ("RAW_DATA", VariantType()),
    ("_LOADED_AT", TimestampNTZType()),
    ("_FILENAME", StringType()),
    ("_FILE_ROW_NUM", LongType()),
    ("_BATCH_ID", StringType()),
    ("_SCHEMA_FP", StringType()),
    ("DATA_DOMAIN", StringType()),
    ("CORRECTION_FL", StringType()),
    ("FILE_RECORD_NBR", LongType()),
    ("JOB_VERSION_NM", StringType()),
    ("PROVIDER_FILE_ID", DecimalType(38, 0)),
    ("PROVIDER_FILE_DT", TimestampNTZType()),
    ("UNIQUE_HASH_ID", StringType()),
    ("UPDATED_BY_USER_ID", StringType()),
    ("PROVIDER_NM", StringType()),
    ("CREATED_DTS", TimestampType()),
    ("PROVIDER_FILE_NM", StringType()),
    ("UPDATED_DTS", TimestampType()),
    ("CREATED_BY_USER_ID", StringType()),
    ("FILE_CORRECTION_DTS", TimestampNTZType()),
    ("ROW_HASH_ID", StringType()),
    ("ACQ_REPROCESSING_DTM", TimestampNTZType()),
]
MIRROR_SCHEMA = StructType([StructField(n, t) for n, t in MIRROR_COLUMNS])

# Run-context and metadata entries that go to a column of the same name.
CONTEXT_COLUMNS = [
    "DATA_DOMAIN",
    "CORRECTION_FL",
    "PROVIDER_NM",
    "PROVIDER_FILE_DT",
    "FILE_CORRECTION_DTS",
    "ACQ_REPROCESSING_DTM",
]
METADATA_COLUMNS = ["JOB_VERSION_NM", "PROVIDER_FILE_ID"]


@dataclass(frozen=True)
class Lineage:
    """What a load knows about itself; every technical column derives from it."""

    batch_id: str
    context: dict = field(default_factory=dict)
    metadata: dict = field(default_factory=dict)
    loaded_at: datetime | None = None
    user: str | None = None

    @property
    def business_key(self) -> str | None:
        return self.metadata.get("BUSINESS_KEY")

    def moment(self) -> datetime:
        return self.loaded_at or datetime.now(timezone.utc).replace(tzinfo=None)


def open_mirror(spark: SparkSession, path: str, key: str | None = None) -> PartTable:
    """Mirror at `path`; tables written before a column existed show it as NULL.  `key` is the payload key rows are looked up by."""
    return PartTable(
        spark, path, MIRROR_SCHEMA, part="_BATCH_ID", item="_FILENAME", key=value_of(key) if key else None
    )


def technical_columns(
    lineage: Lineage,
    file_name: Column,
    row_number: Column,
    fingerprint: Column,
    business_key: Column | None,
    hashed_row: Column,
) -> dict[str, Column]:
    """All mirror columns but the payload, as expressions over a row and its lineage."""
    given = {**{c: lineage.context.get(c) for c in CONTEXT_COLUMNS},
             **{c: lineage.metadata.get(c) for c in METADATA_COLUMNS}}
    loaded = F.lit(lineage.moment().isoformat(sep=" "))
    user = F.lit(lineage.user) if lineage.user else F.current_user()
    values: dict[str, Column] = {name: F.lit(value) for name, value in given.items()}
    values |= {
        "_LOADED_AT": loaded,
        "CREATED_DTS": loaded,
        "UPDATED_DTS": loaded,
        "_FILENAME": file_name,
        "PROVIDER_FILE_NM": file_name,
        "_FILE_ROW_NUM": row_number,
        "FILE_RECORD_NBR": row_number,
        "_BATCH_ID": F.lit(lineage.batch_id),
        "_SCHEMA_FP": fingerprint,
        "UNIQUE_HASH_ID": key_hash(business_key, file_name),
        "ROW_HASH_ID": hashed_row,
        "CREATED_BY_USER_ID": user,
        "UPDATED_BY_USER_ID": user,
    }
    return {n: values[n].cast(t).alias(n) for n, t in MIRROR_COLUMNS if n in values}


def mirror_rows(rows: DataFrame, payload: Column, technical: dict[str, Column]) -> DataFrame:
    columns = {"RAW_DATA": payload.alias("RAW_DATA"), **technical}
    return rows.select([columns[name] for name, _ in MIRROR_COLUMNS])
