"""Queries over the shared test tables, each with the SQL that must give the same rows."""

from mailfacts.catalogue.oracle import oracle_sql
from mailfacts.catalogue.queries import queries

__all__ = ["oracle_sql", "queries"]
