"""Keeps the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tableflow.sources.tables import Tables


@dataclass(frozen=True)
class Query:
    name: str
    job: Callable[[Tables], DataFrame]
    sql: str | None
    covers: tuple[str, ...]

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.job(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, sql: str | None = None):
    """Register the decorated function of a ``Tables`` under ``name``."""
    def keep(job):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, job, sql, tuple(covers.split()))
        return job
    return keep


def register_all(variants: dict[str, str], covers: str):
    """Register one job under several names, each with the SQL of another way to ask it."""
    def keep(job):
        for name, sql in variants.items():
            register(name, covers, sql)(job)
        return job
    return keep
