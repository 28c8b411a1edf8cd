"""Registered queries over the given tables, each with its SQL oracle where SQL can express it."""

from tidestar.registry import changes, decode, derive, quality, scans, star, streams  # noqa: F401
from tidestar.registry.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
