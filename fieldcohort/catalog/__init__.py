"""Every query on the test tables, next to the SQL it must equal."""

from .registry import Tables, oracle_sql, queries, query

__all__ = ["Tables", "oracle_sql", "queries", "query"]
