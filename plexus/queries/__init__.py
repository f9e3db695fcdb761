"""Registered queries over the given tables, each with the SQL that states its result."""

from plexus.queries.registry import QUERIES, SQL, load_all

__all__ = ["QUERIES", "SQL", "load_all"]
