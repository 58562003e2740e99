"""Updates and deletes: old frame in, new frame out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.operators.load import with_computed
from tableflow.operators.lookups import without
from tableflow.session import materialise
from tableflow.sources.contracts import Contract, children_first


def update_rows(df: DataFrame, hit: Column, assignments: Mapping[str, object],
                contract: Contract | None = None) -> tuple[DataFrame, DataFrame]:
    """Set columns where ``hit`` is true (NULL counts as false); return the new table and the
    changed rows. Computed columns follow."""
    marked = df.withColumn("_hit", F.coalesce(hit, F.lit(False)))
    columns = []
    for field in df.schema:
        column = F.col(field.name)
        if field.name in assignments:
            new = _value(assignments[field.name]).cast(field.dataType)
            column = F.when(F.col("_hit"), new).otherwise(column).alias(field.name)
        columns.append(column)
    changed = marked.select(*columns, "_hit")
    if contract is not None:
        changed = with_computed(changed, contract)
    return changed.drop("_hit"), changed.where("_hit").drop("_hit")


def update_where(df: DataFrame, selector: DataFrame, on: Sequence[str],
                 assignments: Mapping[str, object],
                 contract: Contract | None = None) -> tuple[DataFrame, DataFrame]:
    """``update_rows`` for the rows whose key is in ``selector`` (its keys are written out first,
    see ``delete_where``)."""
    on = list(on)
    chosen = materialise(selector.select(*on).distinct()).withColumn("_chosen", F.lit(True))
    new, affected = update_rows(df.join(chosen, on, "left"), F.col("_chosen"), assignments,
                                contract)
    return new.select(*df.columns), affected.select(*df.columns)


def delete_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true; a NULL predicate keeps the row."""
    return df.where(~F.coalesce(predicate, F.lit(False)))


def delete_where(df: DataFrame, selector: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``selector``.

    The keys are written out first. Their size is then known when the join is planned: few keys are
    broadcast and the table is not shuffled; many keys are joined by sort and merge.
    """
    return without(df, materialise(selector.select(*on).distinct()), on)


def cascade_delete(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract],
                   root: str, selector: DataFrame) -> dict[str, DataFrame]:
    """Delete the selected rows of ``root`` and everything that refers to them.

    ``selector`` holds primary keys of ``root``. Tables are walked parents first. For a table with
    several references the doomed keys of all of them are united before anything below it is
    looked at. The doomed keys of a table with children are written out once, since several
    children read them.
    """
    doomed = {root: materialise(selector.select(*contracts[root].primary_key).distinct())}
    result = {root: without(tables[root], doomed[root], contracts[root].primary_key)}
    for name in reversed(children_first(contracts)):
        contract, hits = contracts[name], []
        for key in contract.foreign_keys:
            if key.parent not in doomed or name == root:
                continue
            gone = doomed[key.parent].select(*[
                F.col(theirs).alias(ours) for ours, theirs in zip(key.columns, key.parent_columns)])
            result[name] = without(result.get(name, tables[name]), gone, key.columns)
            hits.append(tables[name].join(gone, list(key.columns), "left_semi")
                        .select(*contract.primary_key))
        has_children = any(key.parent == name for other in contracts.values()
                           for key in other.foreign_keys)
        if hits and has_children:
            doomed[name] = materialise(reduce(DataFrame.unionByName, hits).distinct())
    return result


def _value(value: object) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
