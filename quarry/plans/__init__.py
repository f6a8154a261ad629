"""Named queries over the driver's tables and the SQL each is checked against."""

from quarry.plans.oracle import oracle_sql
from quarry.plans.registry import queries

__all__ = ["oracle_sql", "queries"]
