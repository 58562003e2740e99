"""Column expressions shared by the reports and the table changes (all run inside the JVM)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
TOTAL = "decimal(38,2)"   # of sums, which have no bound


def ascending(column: str | Column) -> Column:
    """Ascending with NULL last, the order of a plain ascending sort in the rebuilt queries."""
    return _as_column(column).asc_nulls_last()


def descending(column: str | Column) -> Column:
    """Descending with NULL first, the order of a plain descending sort in the rebuilt queries."""
    return _as_column(column).desc_nulls_first()


def descending_nulls_last(column: str | Column) -> Column:
    return _as_column(column).desc_nulls_last()


def money(column: str | Column) -> Column:
    """Exact decimal with two places, so that sums do not depend on the order of the rows."""
    return _as_column(column).cast(MONEY)


def two_part_line(first: str | Column, second: str | Column) -> Column:
    """``first``, one blank, ``second``; the blank stays when ``second`` is NULL."""
    return F.concat(_as_column(first), F.lit(" "), F.coalesce(_as_column(second), F.lit("")))


def within_year(column: str | Column, year: int) -> Column:
    """Half-open date range of one year: unlike ``year(c) = y`` both bounds reach the scan."""
    column = _as_column(column)
    return (column >= F.lit(dt.date(year, 1, 1))) & (column < F.lit(dt.date(year + 1, 1, 1)))


def years_until(as_of: dt.date, year: str | Column) -> Column:
    return F.lit(as_of.year) - _as_column(year)


def percent_to_fraction(percent: str | Column) -> Column:
    return (_as_column(percent) / F.lit(100)).cast("decimal(5,2)")


def number_after(column: str | Column, prefix: str) -> Column:
    """The whole number left when ``prefix`` is taken out of the text; other text is an error."""
    return F.replace(_as_column(column), F.lit(prefix), F.lit("")).cast("bigint")


def third_key(key: str | Column) -> Column:
    """The key, or one of the two before it, so that of any three keys in a row the first gets what
    belongs to all: rows stay as many, and most parents have no children."""
    key = _as_column(key)
    return key - (key - 1) % 3


def conditional_count(condition: Column) -> Column:
    """Number of rows that meet the condition, 0 where none does."""
    return F.sum(F.when(condition, F.lit(1)).otherwise(F.lit(0)))


def size_pretty(size: str | Column) -> Column:
    """Bytes as readable text: a unit is used until its rounded value reaches 10240."""
    size = _as_column(size).cast("bigint")
    text = None
    for power, unit in ((5, "PB"), (4, "TB"), (3, "GB"), (2, "MB"), (1, "kB")):
        scale = 1024 ** power
        label = F.concat(F.round(size / F.lit(scale)).cast("bigint").cast("string"),
                         F.lit(f" {unit}"))
        floor = 10 * 1024 if power == 1 else 10 * scale - scale // 2048
        text = F.when(size >= floor, label) if text is None else text.when(size >= floor, label)
    return text.otherwise(F.concat(size.cast("string"), F.lit(" bytes")))


def _as_column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
