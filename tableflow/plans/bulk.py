"""Life of one bulk table: fill it, delete a third, compact it, empty it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.functions.columns import number_after
from tableflow.operators.change import delete_rows
from tableflow.session import materialise
from tableflow.sources.catalog import Schema


def numbered_texts(numbers: DataFrame, prefix: str) -> DataFrame:
    """One text per row of ``numbers`` (column x): the prefix and the number."""
    return numbers.select(F.concat(F.lit(prefix), F.col("x").cast("string")).alias("col"))


def is_third(prefix: str) -> Column:
    """Whether the number of a text is a multiple of three."""
    return number_after("col", prefix) % 3 == 0


def without_thirds(texts: DataFrame, prefix: str) -> DataFrame:
    """The texts whose number is no multiple of three."""
    return delete_rows(texts, is_third(prefix))


def lifecycle(schema: Schema, name: str, numbers: DataFrame, prefix: str,
              file_bytes: int = 128 << 20) -> DataFrame:
    """Run all steps on texts of ``numbers`` (column x); return step, row_count and total_bytes of
    the table after each."""
    after = []

    def note(step: str) -> None:
        after.append(materialise(schema.footprint(name).select(F.lit(step).alias("step"), "row_count", "total_bytes")))

    schema.create_as(name, numbered_texts(numbers, prefix))
    note("create")
    schema.delete(name, is_third(prefix))
    note("delete")
    schema.compact(name, file_bytes)
    note("compact")
    schema.truncate(name)
    note("truncate")
    return reduce(DataFrame.unionByName, after)
