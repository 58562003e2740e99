"""Joins that look something up: natural keys, counts per key, latest rows, first keys.

Nothing here forces a broadcast. Inline row sets carry their exact size, and for every other side
Spark compares its size with ``spark.sql.autoBroadcastJoinThreshold`` when it plans and again when
the shuffle has run, and keeps the sort-merge join (with skew splitting) beyond that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that may be chosen by hand for a cross join with all rows of another table.
MOST_CHOSEN = 1000


class TooManyRows(Exception):
    """A side that was to be a few named rows has more."""


@dataclass(frozen=True)
class Coded:
    """Rows that hold codes in place of natural keys. ``names`` maps each code column to a frame of
    that column and of the natural keys it stands for.

    It means the rows joined with all ``names`` on the codes: a code without a name drops its rows, a
    code with several repeats them.
    """

    rows: DataFrame
    names: Mapping[str, DataFrame]


def resolve_coded(batch: Coded, dims: Mapping[str, DataFrame],
                  lookups: Sequence[tuple[str, Mapping[str, str], Mapping[str, str]]]) -> DataFrame:
    """``resolve_keys`` for all ``lookups`` (dim, on, take). Natural keys are looked up once for each
    code, not once for each row; the rows then meet the ids by their codes, so they are shuffled once
    a code and never carry the natural keys."""
    rows, names = batch.rows, dict(batch.names)
    for dim, on, take in lookups:
        code = next((code for code, named in names.items() if set(on) <= set(named.columns)), None)
        if code is None:
            rows = resolve_keys(rows, dims[dim], on, take)
        else:
            names[code] = resolve_keys(names[code], dims[dim], on, take)
    for code, named in names.items():
        rows = rows.join(named, code).drop(code)
    return rows


def resolve_keys(batch: DataFrame, dim: DataFrame, on: Mapping[str, str],
                 take: Mapping[str, str]) -> DataFrame:
    """Swap natural keys of ``batch`` for columns of ``dim``.

    ``on`` maps batch column -> dim column, ``take`` maps dim column -> name in the result. Batch
    rows without a match are dropped; a batch row with several matches is repeated, once for each.
    """
    side = dim.select(*[F.col(theirs).alias(f"_on_{ours}") for ours, theirs in on.items()],
                      *[F.col(theirs).alias(f"_take_{name}") for theirs, name in take.items()])
    condition = [batch[ours] == side[f"_on_{ours}"] for ours in on]
    joined = batch.join(side, condition, "inner")
    kept = [F.col(name) for name in batch.columns if name not in on]
    return joined.select(*kept, *[F.col(f"_take_{name}").alias(name) for name in take.values()])


def count_per_key(rows: DataFrame, key: str, name: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def with_count(parents: DataFrame, children: DataFrame, key: str, name: str,
               zero: bool = True) -> DataFrame:
    """Number of children per parent. Parents without children get 0, or NULL if not ``zero``."""
    joined = parents.join(count_per_key(children, key, name), key, "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(0))) if zero else joined


def parents_with_children(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """A left join as two: each child with its parent, which Spark can split at a hot key (it cannot
    split the right side of a left join), and the parents without children."""
    there = parents.join(children, key)
    return there.unionByName(without(parents, children, [key]), allowMissingColumns=True)


def few_keys(chosen: DataFrame, key: str, most: int = MOST_CHOSEN) -> list:
    """The keys of a few ``chosen`` rows as values. More than ``most`` are an error (``TooManyRows``),
    so what comes to the driver and goes to all tasks is bounded."""
    found = [row[0] for row in chosen.select(key).limit(most + 1).collect()]
    if len(found) > most:
        raise TooManyRows(f"more than {most} rows chosen by {key}")
    return found


def with_each_key(rows: DataFrame, chosen: DataFrame, key: str, most: int = MOST_CHOSEN) -> DataFrame:
    """Every row with every key of the few ``chosen`` rows: none, one or several copies.

    The keys are found first (``few_keys``), by a filter that reaches the scan. They are then one
    array value beside the rows, and nothing is shuffled. A NULL key gives rows like any other.
    """
    found, kind = few_keys(chosen, key, most), chosen.schema[key].dataType
    if not found:
        return rows.where(F.lit(False)).withColumn(key, F.lit(None).cast(kind))
    each = F.array(*[F.lit(value) for value in found]).cast(T.ArrayType(kind))
    return rows.withColumn(key, F.explode(each))


def latest_value(rows: DataFrame, key: str, value: str, order: Sequence[str],
                 name: str) -> DataFrame:
    """``value`` of each key's last row by ``order`` (end it with a unique column)."""
    return rows.groupBy(key).agg(F.max_by(value, F.struct(*order)).alias(name))


def first_key(rows: DataFrame, key: str) -> Column:
    """Smallest key as a value: NULL when there are no rows. Same as sorting and taking one row,
    without the sort."""
    return rows.agg(F.min(key)).scalar()


def only_value(rows: DataFrame, column: str) -> Column:
    """The one value of ``column``: NULL for no rows, an error for more than one row."""
    return rows.select(column).scalar()


def without(rows: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``others``; a NULL in a key never matches. ``distinct`` folds a hot
    key of the others before it is shuffled."""
    keys = list(keys)
    return rows.join(others.select(*keys).distinct(), keys, "left_anti").select(*rows.columns)


def unseen(batch: DataFrame, target: DataFrame, keys: Sequence[str], cut: bool = True) -> DataFrame:
    """``without``, for a batch that may be much smaller than the target.

    Only keys of the batch can matter, so the target is first ``cut`` down to them. A small batch is
    then broadcast over the target, and the target's rows are not shuffled. A batch that is known to
    be too large for that would be shuffled twice: then the target is not cut.
    """
    keys = list(keys)
    present = target.select(*keys).join(batch.select(*keys), keys, "left_semi") if cut else target
    return without(batch, present, keys)


def link_by_names(mapping: DataFrame, left: DataFrame, left_on: Sequence[str],
                  right: DataFrame, right_on: Sequence[str]) -> DataFrame:
    """Pairs of ``left`` and ``right`` rows named together in ``mapping``.

    Replaces a join on an OR of constants. Both sides are cut down to the names in the mapping
    before they meet.
    """
    left_on, right_on = list(left_on), list(right_on)
    named_left = left.join(mapping, left_on, "inner")
    named_right = right.join(mapping.select(*right_on).distinct(), right_on, "left_semi")
    return named_left.join(named_right, right_on, "inner")
