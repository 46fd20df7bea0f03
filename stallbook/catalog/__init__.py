"""Registered queries: each operator or pipeline run over the supplied tables, with its SQL."""

from __future__ import annotations

from stallbook.catalog import (  # noqa: F401
    aggregates, columns, composites, dimensions, functions, joins, merges, pipelines, sinks, sources, unions,
    windows,
)
from stallbook.catalog import jobs  # noqa: E402, F401  (after the queries whose SQL it builds on)
from stallbook.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
