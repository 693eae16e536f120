"""All named queries."""

from __future__ import annotations

from trackloom.plans import boxes, fused, looks, ordered, relational, reports, streams, sync  # noqa: F401  they register their queries
from trackloom.plans.stage import CATALOG


def queries() -> dict:
    return {name: f for name, (f, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in CATALOG.items() if sql}
