"""Registered queries, one or more for each operator."""

from __future__ import annotations

from . import aggregates, filters, gates, graph, joins, keys, plans, projections, scoring, sinks, sources, streams, text, windows  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
