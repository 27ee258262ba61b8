"""Queries and their SQL by name."""

from __future__ import annotations

from dialoom.plans import check_queries, dialogue_queries, period_queries, queries as plain  # noqa: F401  (the first three register their own)

FLAGSHIP = "q_entity_metrics"


def queries() -> dict:
    return dict(plain.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(plain.ORACLES)
