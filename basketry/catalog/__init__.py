"""Every query of the engine with the SQL that must give the same rows."""

from __future__ import annotations

from basketry.catalog.registry import REGISTRY, Entry
from basketry.catalog import ingest as _ingest, metrics as _metrics, retail as _retail, tables as _tables, entities as _entities  # noqa: F401

__all__ = ["REGISTRY", "Entry"]
