"""Registered queries over the given tables, each with its SQL counterpart."""

from __future__ import annotations

from sluiceway.registry import audit, checks, domains, files, guards, keys, reading, staging, state, streams
from sluiceway.registry.base import Query


def all_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in (checks, keys, staging, audit, files, domains, streams, state, reading, guards):
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            found[name] = query
    return found
