"""Registered queries of the station operators."""

from . import derive_queries, filter_queries, grid_queries, level4_queries, report_queries
from .stations import QUERIES, SQL

__all__ = ["derive_queries", "filter_queries", "grid_queries", "level4_queries", "oracle_sql", "queries", "report_queries"]


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(SQL)
