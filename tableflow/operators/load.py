"""Rerunnable inserts: skip what is there, fill defaults, compute columns, give out ids."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.operators.lookups import unseen
from tableflow.session import materialise
from tableflow.sources.contracts import NOW, TODAY, Contract
from tableflow.sources.tables import seed_frame


def apply_defaults(batch: DataFrame, contract: Contract, as_of: dt.datetime) -> DataFrame:
    """All contract columns but the id, typed. Defaults go only to columns the batch lacks, so a
    NULL given on purpose stays NULL. Computed columns are always computed. A batch column that the
    contract does not know is an error, since it may be a misspelt one."""
    unknown = sorted(set(batch.columns) - set(contract.column_names))
    if unknown:
        raise ValueError(f"{contract.name} has no columns {unknown}")
    values: dict[str, Column] = {}
    for column in contract.columns:
        if column.name == contract.identity or column.name in contract.computed:
            continue
        if column.name in batch.columns:
            value = F.col(column.name)
        else:
            value = F.lit(default_value(contract.defaults.get(column.name), as_of))
        values[column.name] = value.cast(column.type).alias(column.name)
    return with_computed(batch.select(*values.values()), contract)


def default_value(default, as_of: dt.datetime):
    """The value to fill in. The time goes as text, since a Python time would be moved between the
    time zones of Python and of the session."""
    if default is TODAY:
        return as_of.date()
    return as_of.isoformat(sep=" ") if default is NOW else default


def with_computed(df: DataFrame, contract: Contract) -> DataFrame:
    for name, expression in contract.computed.items():
        df = df.withColumn(name, F.expr(expression).cast(contract.type_of(name)))
    return df


def assign_ids(df: DataFrame, id_column: str, first_id: int | Column = 1) -> DataFrame:
    """Number the rows first_id, first_id + 1, ... without a sort or a shuffle.

    The rows are written out, and each is numbered by its file and its place there, so that the counts
    and the numbering see the same rows even if tasks are retried. Only one count per file comes to
    the driver; the size of the offsets is bounded by the number of files.
    """
    staged = materialise(df, codec="zstd").select("*", F.col("_metadata.file_name").alias("_file"),
                                                  F.col("_metadata.row_index").alias("_row"))
    counts = staged.groupBy("_file").count().collect()
    offsets, total = [], 0
    for file, rows in sorted((row["_file"], row["count"]) for row in counts):
        offsets.append((file, total))
        total += rows
    start = seed_frame(df.sparkSession, offsets, "_file string, _offset long")
    first = F.lit(first_id) if isinstance(first_id, int) else first_id
    numbered = staged.join(F.broadcast(start), "_file")
    return numbered.select((first + F.col("_offset") + F.col("_row")).alias(id_column), *df.columns)


def next_id(target: DataFrame, id_column: str) -> Column:
    return F.coalesce(target.agg(F.max(id_column)).scalar(), F.lit(0)) + F.lit(1)


def new_rows(target: DataFrame, batch: DataFrame, contract: Contract, keys: Sequence[str],
             as_of: dt.datetime, first_id: int | Column | None = None, empty: bool = False,
             cut: bool = True) -> DataFrame:
    """The batch rows whose key is not in ``target``, as rows of it: typed, with defaults, computed
    columns and ids (after the highest of the target, if ``first_id`` is not given).

    Like the checks it stands for, this compares with the target only: copies inside one batch
    all go in, and are left to the audit's unique rules. Nothing is compared with a target that is
    known to be ``empty``, so a first load works the batch out once. Else the batch is read twice;
    one that comes out of joins should be written out before (``materialise``): its size is then
    known when the plan is made, so that a small one is broadcast to a large target.
    """
    if not empty:
        batch = unseen(batch, target, keys, cut)
    added = apply_defaults(batch, contract, as_of)
    if contract.identity:
        first = next_id(target, contract.identity) if first_id is None else first_id
        added = assign_ids(added, contract.identity, first)
    return added.select(*contract.column_names)


def insert_new(target: DataFrame, batch: DataFrame, contract: Contract, keys: Sequence[str],
               as_of: dt.datetime, empty: bool = False) -> tuple[DataFrame, DataFrame]:
    """Add the ``new_rows`` of the batch; return the new table and the added rows."""
    added = new_rows(target, batch, contract, keys, as_of, empty=empty)
    return target.select(*contract.column_names).unionByName(added), added


def add_column(df: DataFrame, name: str, default, type_name: str) -> DataFrame:
    """Add the column with its default if absent, else fill its NULLs."""
    value = F.lit(default).cast(type_name)
    if name in df.columns:
        value = F.coalesce(F.col(name), value)
    return df.withColumn(name, value)
