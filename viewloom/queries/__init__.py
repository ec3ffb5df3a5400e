"""Every operator on the test tables. Importing the modules fills the registry."""

from viewloom.queries import base, joins, metadata, nodes, scalars, sources, text, windows, composites  # noqa: F401
from viewloom.queries.base import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
