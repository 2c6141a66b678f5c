"""Registered queries: one per operator, with the SQL that must give the same rows."""

from __future__ import annotations

from .registry import ORACLE_SQL, QUERIES, flagship

__all__ = ["ORACLE_SQL", "QUERIES", "flagship"]
