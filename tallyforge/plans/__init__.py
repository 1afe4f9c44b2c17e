"""Queries over the star schema and event tables, with the SQL that gives the same rows."""

from . import documented, features, game, legacy, loads, repairs, reports, scalars, star, tables  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
