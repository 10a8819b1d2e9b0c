"""Registered queries over the supplied tables, each with SQL to hold it against."""

from siltworks.plans import audits, changes, continuity, joining, merging, notes, ranking, records, rollups, streams, texts  # noqa: F401
from siltworks.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
