"""Every operator and job as a query over the given tables, with its SQL counterpart."""

from ledgerloom.queries import cleaning, files, jobs, lookups, mapping, mutation, premium, profiles
from ledgerloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "cleaning", "files", "jobs", "lookups", "mapping", "mutation", "premium", "profiles"]
