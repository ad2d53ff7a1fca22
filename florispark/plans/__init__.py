"""Queries over the test tables, each with the SQL that another engine runs for comparison."""

from . import joins, matching, mining, records, reports, serving, storage, structures, surface  # noqa: F401
from .domain import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
