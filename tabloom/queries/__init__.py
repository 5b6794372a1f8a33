"""Registered queries with the SQL that checks them, one module per group of operators."""

from tabloom.queries import (  # noqa: F401
    chains,
    cleaning,
    ensembles,
    features,
    fitted,
    metrics,
    models,
    searches,
    sources,
    tracking,
)
from tabloom.queries.common import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
