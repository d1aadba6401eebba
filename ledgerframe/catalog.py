"""All queries of the library outside its corpus part."""

from .plans.audit_queries import queries
from .plans.oracle import SQL

__all__ = ["oracle_sql", "queries"]


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
