"""Registered queries: each has a Spark job, usually an SQL text to check it by, and the survey
rows it covers. The jobs read the whole sales tables of a folder."""

from __future__ import annotations

from tableflow.queries.registry import REGISTRY
from tableflow.queries import audits, basics, changes, loads, reports  # noqa: F401  (register)

__all__ = ["REGISTRY"]
