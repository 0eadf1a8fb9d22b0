"""Loads every query module and exposes the registry."""

from holdsift.plans import queries_reports, queries_signals, queries_streams, queries_tables, queries_urls  # noqa: F401
from holdsift.plans.registry import QUERIES, SQL  # noqa: F401
