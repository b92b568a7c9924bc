"""Every query of the library, with the SQL another engine can check it against."""

from __future__ import annotations

from martloom.catalog import (  # noqa: F401  (importing registers the entries)
    aggregates,
    expressions,
    extras,
    io,
    live,
    models,
    quality,
    relational,
)
from martloom.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
