"""Registered queries, each with the SQL that checks it."""

from deskmill.plans import conversations, documents, tables  # noqa: F401
from deskmill.plans.registry import CHECKS, JOBS

__all__ = ["CHECKS", "JOBS"]
