"""All registered queries."""

from __future__ import annotations

from . import (  # noqa: F401
    q_aggregates,
    q_clean,
    q_enrich,
    q_evaluate,
    q_forecast,
    q_joins,
    q_models,
    q_serve,
    q_sources,
    q_windows,
)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
