"""Queries over the test tables, one module per area."""

from registry import models, scores, stages, text_rows  # noqa: F401
from registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
