"""Queries over a data folder, their SQL, and the batch job."""

from tradewind.plans import exchange, operations  # noqa: F401  register their queries
from tradewind.plans.analytics import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
