"""All named queries of the core library and their SQL counterparts."""

from __future__ import annotations

from quernstone.plans import corpus, exchange, fields, matching, reading, records, timestamps, upkeep

_MODULES = [timestamps, corpus, matching, fields, reading, records, exchange, upkeep]


def queries() -> dict:
    return {k: v for m in _MODULES for k, v in m.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in _MODULES for k, v in m.oracle_sql().items()}
