"""Named queries over the test tables and their oracle SQL."""

from obslog.plans.oracle import ORACLE_SQL
from obslog.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
