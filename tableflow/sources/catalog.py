"""Tables by name in Spark's catalog: created, filled, changed, packed and measured.

``Schema`` stands for one schema of the session's catalog. Its tables are managed Parquet tables in
Spark's warehouse folder, which all executors have to reach, and ``spark.sql`` sees them.

* An insert appends the new rows and nothing else; no rows, no file.
* A delete, update or backfill finds the partitions that hold a hit and rewrites those; the others
  keep their files. A table without partitions is rewritten whole.
* What is checked is written out and audited before the table is touched, so a refused change leaves
  no trace in it.

Rewritten partitions are staged in the shared folder and replaced by one insert. A whole table is
written under a second name, which then takes the place of the first. A frame of a table that was
read before a rewrite may name files that are gone; read it again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.functions.columns import size_pretty
from tableflow.operators.audit import audit, audit_added, audit_deleted
from tableflow.operators.change import update_rows
from tableflow.operators.load import new_rows
from tableflow.session import materialise
from tableflow.sources.contracts import Contract

FAR_FEWER = 4  # a table is cut down to the keys of a batch if it has so many times its rows

Hit = Column | Callable[[DataFrame], Column]


class ContractViolation(Exception):
    """The rows break their contracts; no table was changed."""

    def __init__(self, violations: list):
        self.violations = violations
        super().__init__("; ".join(f"{v.table_name}: {v.rule}: {v.violations} (e.g. {v.sample})"
                                   for v in violations))


def refuse_violations(found: DataFrame) -> None:
    broken = found.where("violations > 0").collect()  # one row a rule
    if broken:
        raise ContractViolation(broken)


class Schema:
    def __init__(self, spark: SparkSession, name: str, codec: str | None = None):
        """``codec`` compresses the files of tables that are made here, if not that of the session."""
        self.spark, self.name, self.codec = spark, name, codec
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")

    # Reading

    def full(self, name: str) -> str:
        return f"`{self.name}`.`{name}`"

    def names(self) -> list[str]:
        tables = self.spark.sql(f"SHOW TABLES IN `{self.name}`").where("NOT isTemporary")
        return [row.tableName for row in tables.collect()]

    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.full(name))

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self.full(name))

    def frames(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in self.names()}

    def partition_columns(self, name: str) -> list[str]:
        return [column.name for column in self.spark.catalog.listColumns(self.full(name)) if column.isPartition]

    def location(self, name: str) -> str:
        about = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.full(name)}")
        return about.where("col_name = 'Location'").first().data_type

    # Creating and dropping

    def create_as(self, name: str, frame: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """New table from a query; an error if the table is there."""
        options = {"compression": self.codec} if self.codec else {}
        (frame.write.format("parquet").options(**options).partitionBy(*partition_by).mode("errorifexists")
         .saveAsTable(self.full(name)))

    def create_missing(self, contracts: Mapping[str, Contract],
                       partition_by: Mapping[str, Sequence[str]] | None = None) -> list[str]:
        """Empty tables for all contracts whose table is absent; return their names."""
        known = set(self.names())
        for name, contract in contracts.items():
            columns = ", ".join(f"`{c.name}` {c.type.simpleString()}" for c in contract.columns)
            parts = ", ".join(f"`{c}`" for c in (partition_by or {}).get(name, ()))
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.full(name)} ({columns}) USING parquet"
                           + (f" OPTIONS (compression '{self.codec}')" if self.codec else "")
                           + (f" PARTITIONED BY ({parts})" if parts else ""))
        return [name for name in contracts if name not in known]

    def drop(self) -> None:
        self.spark.sql(f"DROP SCHEMA IF EXISTS `{self.name}` CASCADE")

    def truncate(self, name: str) -> None:
        """Make the table empty without looking at its rows."""
        self.spark.sql(f"TRUNCATE TABLE {self.full(name)}")

    # Adding rows

    def append(self, name: str, rows: DataFrame) -> None:
        """Add rows by column name; the files that are there stay as they are."""
        if not rows.isEmpty():
            rows.select(*self.table(name).columns).write.insertInto(self.full(name))

    def insert(self, contract: Contract, batch: DataFrame, keys: Sequence[str], as_of: dt.datetime) -> DataFrame:
        """Append the batch rows whose key is not in the table; return them.

        The new rows are written out and audited (``audit_added``) before they are appended, so a bad
        batch raises ``ContractViolation`` and adds nothing. Of the table only keys and the highest
        id are read. A second run of the same batch adds no row and no file.
        """
        added = self._new(contract, batch, keys, as_of)
        rows = added.count()
        if rows:
            beside = {name: (table, table.count()) for name, table in self._beside(contract).items()}
            empty = contract.name in beside and not beside[contract.name][1]
            whole = [name for name, (_, others) in beside.items() if others <= FAR_FEWER * rows]
            refuse_violations(audit_added(added, contract, {name: table for name, (table, _) in beside.items()},
                                          whole, empty))
            self.append(contract.name, added)
        return added

    def _new(self, contract: Contract, batch: DataFrame, keys: Sequence[str], as_of: dt.datetime) -> DataFrame:
        """New rows, written out; ids are given once, so they do not move when the table has grown."""
        target = self.table(contract.name)
        empty = target.isEmpty()
        cut = not empty and FAR_FEWER * batch.count() < target.count()
        if not contract.identity:
            return materialise(new_rows(target, batch, contract, keys, as_of, empty=empty, cut=cut), codec="zstd")
        highest = None if empty else target.agg(F.max(contract.identity)).first()[0]
        return new_rows(target, batch, contract, keys, as_of, (highest or 0) + 1, empty, cut)

    def _beside(self, contract: Contract) -> dict[str, DataFrame]:
        wanted = {contract.name, *(key.parent for key in contract.foreign_keys)}
        return {name: self.table(name) for name in wanted if self.exists(name)}

    # Changing rows

    def delete(self, name: str, hit: Hit, contracts: Mapping[str, Contract] | None = None) -> int:
        """Delete the rows for which ``hit`` is true; return the number of rewritten partitions.

        With contracts, a row that others refer to is not deleted: ``ContractViolation`` is raised.
        """
        if contracts:
            children = {child: self.table(child) for child, contract in contracts.items()
                        if self.exists(child) and any(key.parent == name for key in contract.foreign_keys)}
            table = self.table(name)
            refuse_violations(audit_deleted(table.where(_true(table, hit)), contracts[name], children, contracts))
        return self._rewrite(name, hit, lambda rows: rows.where(~_true(rows, hit)))

    def update(self, name: str, hit: Hit, assignments: Mapping[str, object],
               contract: Contract | None = None, audited: Mapping[str, Contract] | None = None) -> DataFrame:
        """Set columns where ``hit`` is true; return the changed rows, as written out. Partition
        columns cannot be set.

        With ``audited`` contracts the changed rows are checked against their row and reference
        rules, and the unique keys that are assigned to against all keys.
        """
        if set(assignments) & set(self.partition_columns(name)):
            raise ValueError(f"{name}: rows are not moved between partitions")
        table = self.table(name)
        new, changed = update_rows(table, _true(table, hit), assignments, contract)
        changed = materialise(changed)
        if audited:
            refuse_violations(_audit_changed(new, changed, audited[name], assignments, self.frames()))
        self._rewrite(name, hit, lambda rows: update_rows(rows, _true(rows, hit), assignments, contract)[0])
        return changed

    def add_column(self, name: str, column: str, type_name: str, default) -> int:
        """Add the column if it is absent and fill its NULLs; return the number of rewritten
        partitions. Partitions without NULLs keep their files."""
        if column not in self.table(name).columns:
            self.spark.sql(f"ALTER TABLE {self.full(name)} ADD COLUMNS (`{column}` {type_name})")
        value = F.lit(default).cast(type_name)
        return self._rewrite(name, lambda rows: rows[column].isNull(),
                             lambda rows: rows.withColumn(column, F.coalesce(F.col(column), value)))

    def replace(self, name: str, frame: DataFrame) -> None:
        """Put the rows of ``frame`` in place of all rows of the table, or make the table."""
        if not self.exists(name):
            return self.create_as(name, frame)
        kept = self.table(name).schema
        rows = frame.select(*[F.col(field.name).cast(field.dataType).alias(field.name) for field in kept])
        new, old = f"{name}__new", f"{name}__old"
        self.spark.sql(f"DROP TABLE IF EXISTS {self.full(new)}")
        self.create_as(new, rows, self.partition_columns(name))
        self.spark.sql(f"ALTER TABLE {self.full(name)} RENAME TO {self.full(old)}")
        self.spark.sql(f"ALTER TABLE {self.full(new)} RENAME TO {self.full(name)}")
        self.spark.sql(f"DROP TABLE {self.full(old)}")

    def _rewrite(self, name: str, hit: Hit, change: Callable[[DataFrame], DataFrame]) -> int:
        """Rewrite the partitions that hold a hit."""
        table, parts = self.table(name), self.partition_columns(name)
        hits = table.where(_true(table, hit))
        if not parts:
            if hits.isEmpty():
                return 0
            self.replace(name, change(table))
            return 1
        touched = hits.select(*parts).distinct().collect()  # one row a partition
        self._overwrite(name, touched, change)
        return len(touched)

    def _overwrite(self, name: str, touched: list, change: Callable[[DataFrame], DataFrame],
                   settings: Mapping[str, str] | None = None) -> None:
        """Replace the named partitions by what ``change`` makes of them; those of which nothing is
        left are dropped last, so that a change that breaks off can be run again."""
        if not touched:
            return
        parts = self.partition_columns(name)
        writer = self._session({"spark.sql.sources.partitionOverwriteMode": "dynamic", **(settings or {})})
        table = self.table(name)
        rows = change(table.where(reduce(Column.__or__, [_is(row, parts) for row in touched]))).select(*table.columns)
        staged = materialise(rows, writer)
        staged.hint("rebalance", *parts).write.insertInto(self.full(name), overwrite=True)
        self.spark.catalog.refreshTable(self.full(name))
        left = {tuple(row) for row in staged.select(*parts).distinct().collect()}
        for row in touched:
            if tuple(row) not in left:
                named = ", ".join(f"`{part}` = {_literal(row[part])}" for part in parts)
                self.spark.sql(f"ALTER TABLE {self.full(name)} DROP IF EXISTS PARTITION ({named})")

    def _session(self, settings: Mapping[str, str]) -> SparkSession:
        """A session on the same catalog with settings of its own."""
        session = self.spark.newSession()
        for key, value in settings.items():
            session.conf.set(key, value)
        return session

    # Groups

    def publish(self, replaced: Mapping[str, DataFrame] | None = None, added: Mapping[str, DataFrame] | None = None,
                contracts: Mapping[str, Contract] | None = None) -> None:
        """Several tables at once: rows in place of all rows of some, rows added to others.

        Everything is written out at the same time, then audited as the tables will be, and only
        then put in place, table after table. A job that fails or a violation changes no table.
        """
        replaced, added = dict(replaced or {}), dict(added or {})
        with ThreadPoolExecutor(8) as pool:
            written = list(pool.map(materialise, [*replaced.values(), *added.values()]))
        replaced = dict(zip(replaced, written))
        added = dict(zip(added, written[len(replaced):]))
        if contracts:
            now = {**self.frames(), **replaced}
            grown = {name: now[name].unionByName(rows) if name in now else rows for name, rows in added.items()}
            later = {**now, **grown}
            touched = {name: contract for name, contract in contracts.items() if name in later and (
                name in replaced or any(key.parent in replaced for key in contract.foreign_keys))}
            checks = [audit(later, touched)] if touched else []
            for name, rows in added.items():
                beside = {**later, name: now[name]} if name in now else {k: v for k, v in later.items() if k != name}
                checks.append(audit_added(rows, contracts[name], beside))
            if checks:
                refuse_violations(reduce(DataFrame.union, checks))
        for name, rows in replaced.items():
            self.replace(name, rows)
        for name, rows in added.items():
            self.append(name, rows) if self.exists(name) else self.create_as(name, rows)

    # Packing and measuring

    def files(self, name: str) -> DataFrame:
        """Path, length and partition values of the table's files, by a listing."""
        return (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                .load(self.location(name)).drop("content", "modificationTime"))

    def compact(self, name: str, target_bytes: int) -> int:
        """Rewrite the partitions with several files under ``target_bytes`` into files of about that
        size; return their number. Other partitions keep their files."""
        parts = self.partition_columns(name)
        small = self.files(name).groupBy(*parts).agg(F.count_if(F.col("length") < target_bytes).alias("n")).where("n > 1")
        settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
                    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
        if parts:
            types = {field.name: field.dataType for field in self.table(name).schema}
            touched = small.select(*[F.col(part).cast(types[part]) for part in parts]).collect()  # one row a partition
            self._overwrite(name, touched, lambda rows: rows, settings)
            return len(touched)
        if small.isEmpty():
            return 0
        packing = Schema(self._session(settings), self.name, self.codec)
        packing.replace(name, packing.table(name).hint("rebalance"))
        self.spark.catalog.refreshTable(self.full(name))
        return 1

    def footprint(self, like: str = "%") -> DataFrame:
        """Rows, files and bytes of the tables whose name matches the pattern."""
        return footprint({name: (self.table(name), self.location(name)) for name in self.names()}, like)


def _true(rows: DataFrame, hit: Hit) -> Column:
    return F.coalesce(hit(rows) if callable(hit) else hit, F.lit(False))


def _is(row, parts: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(part).eqNullSafe(F.lit(row[part])) for part in parts])


def _literal(value) -> str:
    if value is None:
        return "NULL"
    text = str(value).replace("\\", "\\\\").replace("'", "\\'")
    return text if isinstance(value, (int, float)) else f"'{text}'"


def _audit_changed(new: DataFrame, changed: DataFrame, contract: Contract, assignments: Mapping[str, object],
                   tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row and reference rules on the changed rows; unique keys that are assigned to on all rows."""
    apart = Contract(contract.name, contract.columns, foreign_keys=contract.foreign_keys, checks=contract.checks,
                     computed=contract.computed)
    keys = tuple(keys for keys in (contract.primary_key, *contract.uniques) if set(keys) & set(assignments))
    found = audit_added(changed, apart, {**tables, contract.name: new})
    if not keys:
        return found
    return found.union(audit({contract.name: new}, {contract.name: Contract(contract.name, (), uniques=keys)}))


def footprint(tables: Mapping[str, tuple[DataFrame, str]], like: str = "%") -> DataFrame:
    """Columns table_name, row_count, files, total_bytes, total, of frames and the folders they are in.

    Sizes come from a file listing, row counts from the parquet footers; no column is read. A name
    that does not match is dropped when the plan is made.
    """
    parts = []
    for name, (frame, path) in tables.items():
        files = (frame.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .load(path).agg(F.count("length").alias("files"),
                                 F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes")))
        rows = frame.agg(F.count(F.lit(1)).alias("row_count"))
        parts.append(rows.select(
            F.lit(name).alias("table_name"), "row_count",
            files.select("files").scalar().alias("files"),
            files.select("total_bytes").scalar().alias("total_bytes")))
    sizes = reduce(DataFrame.unionByName, parts).where(F.col("table_name").like(like))
    return sizes.withColumn("total", size_pretty("total_bytes"))
