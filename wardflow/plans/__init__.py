"""Importing this package registers every query."""

from . import basics, clinical, grouping, joining, picking, reading, reshaping, timeline  # noqa: F401
from .registry import REGISTRY, Query, run

__all__ = ["REGISTRY", "Query", "run"]
