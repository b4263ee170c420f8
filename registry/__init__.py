"""Registered queries and the SQL each is checked against."""

from registry import column_queries, flow_queries, log_queries  # noqa: F401
from registry.base import ORACLE, QUERIES  # noqa: F401
