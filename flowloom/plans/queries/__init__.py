"""Operators bound to the provided tables, each with the SQL that must give the same rows."""

from flowloom.plans.queries import certs, cleaning, detection, history, matching, popularity, resolving, series, storage, streams, tables
from flowloom.plans.queries.bindings import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "certs", "cleaning", "detection", "history", "matching", "popularity", "resolving", "series", "storage",
           "streams", "tables"]
