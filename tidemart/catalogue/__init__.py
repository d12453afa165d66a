"""Every operator and job bound to the generated test tables, with an equivalent SQL query."""

from tidemart.catalogue.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
