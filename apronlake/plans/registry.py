"""Every registered query of the analytics engine, and its DuckDB SQL."""

from __future__ import annotations

from . import catalog, checks, features, flows, oracles, scoring, views

QUERIES = catalog.QUERIES | scoring.QUERIES | views.QUERIES | flows.QUERIES | features.QUERIES | checks.QUERIES
ORACLES = oracles.ORACLES | scoring.ORACLES | views.ORACLES | flows.ORACLES | features.ORACLES | checks.ORACLES

__all__ = ["ORACLES", "QUERIES"]
