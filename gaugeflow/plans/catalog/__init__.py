"""Registered queries, one per operator, each with the SQL that has to give the same rows."""

from __future__ import annotations

from gaugeflow.plans.catalog.base import ORACLE, QUERIES


def load() -> tuple[dict, dict]:
    from gaugeflow.plans.catalog import (  # noqa: F401
        aggregates,
        entities,
        expressions,
        jobs,
        lookups,
        sources,
        streams,
        validators,
    )

    return dict(QUERIES), dict(ORACLE)
