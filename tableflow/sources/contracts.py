"""What a table must look like: columns, keys, references, checks, defaults, computed columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from graphlib import TopologicalSorter

from pyspark.sql import types as T


class _Marker:
    def __init__(self, name: str):
        self.name = name

    def __repr__(self) -> str:
        return self.name


TODAY = _Marker("TODAY")  # default: the date of the run
NOW = _Marker("NOW")      # default: the time of the run

ID, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
DATE, TIME = T.DateType(), T.TimestampNTZType()


def decimal(precision: int, scale: int = 2) -> T.DecimalType:
    return T.DecimalType(precision, scale)


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    nullable: bool = False
    length: int | None = None


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Column, ...]
    primary_key: tuple[str, ...] = ()
    identity: str | None = None
    uniques: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    checks: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)
    computed: Mapping[str, str] = field(default_factory=dict)

    @property
    def column_names(self) -> list[str]:
        return [column.name for column in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, True) for c in self.columns])

    def type_of(self, name: str) -> T.DataType:
        return next(column.type for column in self.columns if column.name == name)


def text(name: str, length: int | None = None, nullable: bool = False) -> Column:
    return Column(name, TEXT, nullable, length)


def reference(column: str, parent: str, parent_column: str | None = None) -> ForeignKey:
    return ForeignKey((column,), parent, (parent_column or column,))


def children_first(contracts: Mapping[str, Contract]) -> list[str]:
    """Table names ordered so that a table comes before every table it refers to."""
    order = TopologicalSorter()
    for name, contract in contracts.items():
        order.add(name)
        for key in contract.foreign_keys:
            if key.parent != name and key.parent in contracts:
                order.add(key.parent, name)
    return list(order.static_order())
