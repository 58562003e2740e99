"""Data contracts checked by Spark jobs: one row per rule with the number of violations.

All rules that look at single rows share one scan and one aggregate per table. A uniqueness rule is
one aggregate on its keys. A reference rule folds the child to its distinct keys before the join,
so a hot key is one row by then.

The rules are SQL expressions, as the checks of a contract are.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tableflow.sources.contracts import Contract, ForeignKey


def audit(tables: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """Columns table_name, rule, violations, sample (one offending key as JSON).

    Violations are rows for row and reference rules, and repeated keys for unique rules. Only
    tables given are checked; a reference to a table that is not given has NULL violations.
    """
    parts: list[DataFrame] = []
    for name, contract in contracts.items():
        if name not in tables:
            continue
        df = tables[name]
        rules = row_conditions(df, contract)
        if rules:
            parts.append(row_rules(df, contract, rules))
        parts.extend(unique_rule(df, name, keys)
                     for keys in (contract.primary_key, *contract.uniques) if keys)
        parts.extend(reference_rule(df, name, key, tables[key.parent])
                     for key in contract.foreign_keys if key.parent in tables)
        parts.extend(unchecked_reference(df, name, key)
                     for key in contract.foreign_keys if key.parent not in tables)
    return _union(parts)


def audit_added(added: DataFrame, contract: Contract, tables: Mapping[str, DataFrame],
                whole: Collection[str] = (), empty: bool = False) -> DataFrame:
    """``audit`` of rows that are about to be appended to the table of the contract.

    Only the added rows are looked at, and the key columns of the target and of the parents, cut
    down to the keys of the added rows: a small batch never shuffles a large table. ``tables`` holds
    the target (if it is there) and the parents as they will be. A generated primary key is taken
    for unique, since ids follow the highest one. Parents named in ``whole``, those that are not much
    larger than the batch, are not cut down, which would shuffle the batch once more; nor is a target
    that is known to be ``empty``.
    """
    name, target = contract.name, tables.get(contract.name)
    parts: list[DataFrame] = []
    rules = row_conditions(added, contract)
    if rules:
        parts.append(row_rules(added, contract, rules))
    generated = contract.primary_key == (contract.identity,)
    for keys in (() if generated else contract.primary_key, *contract.uniques):
        if keys:
            own = added.select(*keys)
            there = () if target is None or empty else (target.select(*keys).join(own, list(keys), "left_semi"),)
            parts.append(unique_rule(_union([own, *there]), name, keys))
    for key in contract.foreign_keys:
        if key.parent not in tables:
            parts.append(unchecked_reference(added, name, key))
            continue
        parent = tables[key.parent].select(*key.parent_columns)
        wanted = added.select(*[added[ours].alias(theirs) for ours, theirs in zip(key.columns, key.parent_columns)])
        if key.parent == name:  # rows that come together may refer to each other
            parent = parent.unionByName(added.select(*key.parent_columns))
        if key.parent not in whole:
            parent = parent.join(wanted, list(key.parent_columns), "left_semi")
        parts.append(reference_rule(added, name, key, parent))
    return _union(parts)


def audit_deleted(gone: DataFrame, contract: Contract, children: Mapping[str, DataFrame],
                  contracts: Mapping[str, Contract]) -> DataFrame:
    """Rows of the children that refer to the rows that are about to be deleted."""
    parts: list[DataFrame] = []
    for name, child in children.items():
        for key in contracts[name].foreign_keys:
            if key.parent == contract.name:
                keys = gone.select(*[gone[theirs].alias(ours) for ours, theirs in zip(key.columns, key.parent_columns)])
                held = _copies(child.join(keys.distinct(), list(key.columns), "left_semi"), key.columns)
                parts.append(held.selectExpr(*_found(name, f"reference {', '.join(key.columns)} -> {key.parent}",
                                                     "coalesce(sum(_rows), 0)", key.columns)))
    if not parts:
        return gone.sparkSession.createDataFrame([], "table_name string, rule string, violations long, sample string")
    return _union(parts)


def row_conditions(df: DataFrame, contract: Contract) -> dict[str, str]:
    """Rule name -> condition that is true for an offending row (a NULL check result passes)."""
    rules: dict[str, str] = {}
    types = {field.name: field.dataType for field in df.schema}
    required = [column.name for column in contract.columns if not column.nullable]
    for name in dict.fromkeys([*contract.primary_key, *required]):
        rules[f"not null {name}"] = f"`{name}` IS NULL"
    for column in contract.columns:
        if column.length is not None:
            rules[f"length {column.name}"] = f"length(`{column.name}`) > {column.length}"
        if isinstance(column.type, T.DecimalType) and types[column.name] != column.type:
            rules[f"type {column.name}"] = (
                f"`{column.name}` IS NOT NULL AND "
                f"try_cast(`{column.name}` AS {column.type.simpleString()}) IS NULL")
    for name, condition in contract.checks.items():
        rules[f"check {name}"] = f"NOT ({condition})"
    for name, expression in contract.computed.items():
        type_name = contract.type_of(name).simpleString()
        rules[f"computed {name}"] = f"NOT (`{name}` <=> CAST({expression} AS {type_name}))"
    return rules


def row_rules(df: DataFrame, contract: Contract, rules: Mapping[str, str]) -> DataFrame:
    """All row rules of one table in one aggregate."""
    key = _json(contract.primary_key or contract.column_names)
    counted = df.selectExpr(*[
        aggregate for i, condition in enumerate(rules.values()) for aggregate in (
            f"count_if({condition}) AS n{i}", f"min(CASE WHEN {condition} THEN {key} END) AS s{i}")])
    found = ", ".join(
        f"struct({_text(contract.name)} AS table_name, {_text(rule)} AS rule, "
        f"n{i} AS violations, s{i} AS sample)" for i, rule in enumerate(rules))
    return counted.selectExpr(f"inline(array({found}))")


def unique_rule(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys with a NULL in them are exempt."""
    return (_copies(df, keys).where("_rows > 1")
            .selectExpr(*_found(name, f"unique {', '.join(keys)}", "count(1)", keys)))


def unchecked_reference(df: DataFrame, name: str, key: ForeignKey) -> DataFrame:
    rule = f"reference {', '.join(key.columns)} -> {key.parent}"
    return df.sparkSession.range(1).selectExpr(
        f"{_text(name)} AS table_name", f"{_text(rule)} AS rule", "CAST(NULL AS BIGINT) AS violations",
        "CAST(NULL AS STRING) AS sample")


def reference_rule(df: DataFrame, name: str, key: ForeignKey, parent: DataFrame) -> DataFrame:
    """Child rows whose key has no parent; keys with a NULL in them are exempt."""
    known = parent.selectExpr(*[f"`{theirs}` AS `{ours}`"
                                for ours, theirs in zip(key.columns, key.parent_columns)])
    orphans = _copies(df, key.columns).join(known, list(key.columns), "left_anti")
    rule = f"reference {', '.join(key.columns)} -> {key.parent}"
    return orphans.selectExpr(*_found(name, rule, "coalesce(sum(_rows), 0)", key.columns))


def _copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    known = " AND ".join(f"`{key}` IS NOT NULL" for key in keys)
    return df.where(known).groupBy(*keys).count().withColumnRenamed("count", "_rows")


def _found(name: str, rule: str, violations: str, keys: Iterable[str]) -> list[str]:
    return [f"{_text(name)} AS table_name", f"{_text(rule)} AS rule",
            f"CAST({violations} AS BIGINT) AS violations", f"min({_json(keys)}) AS sample"]


def _json(columns: Iterable[str]) -> str:
    return f"to_json(struct({', '.join(f'`{column}`' for column in columns)}))"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    """Union in halves: every step is analysed anew, so a chain of unions would be slow to plan."""
    if len(parts) == 1:
        return parts[0]
    middle = len(parts) // 2
    return _union(parts[:middle]).union(_union(parts[middle:]))
