"""Reading from and building the semi-structured payload column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAYLOAD = "RAW_DATA"


def value_of(key: str, kind: str = "string", payload: str = PAYLOAD) -> Column:
    """Typed value of a payload key; NULL if the key is absent, null or not of the type.

    Spark pushes this into the scan of a shredded variant column, so only the
    keys a query names are read.
    """
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(F.col(payload), f"$['{quoted}']", kind)


def payload_columns(keys: list[str], payload: str = PAYLOAD) -> list[Column]:
    return [value_of(k, payload=payload).alias(k) for k in keys]


def object_of(named: dict[str, Column]) -> Column:
    """Object with every key, null values kept."""
    return F.to_variant_object(F.struct(*[c.alias(n) for n, c in named.items()]))


def object_without_nulls(named: dict[str, Column]) -> Column:
    """Object without the keys whose value is NULL."""
    return F.parse_json(F.to_json(F.struct(*[c.alias(n) for n, c in named.items()])))
