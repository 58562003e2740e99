"""Rerunnable load of the 14 marketplace tables, and the ``record_ts`` backfill."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tableflow.operators.load import add_column, insert_new
from tableflow.operators.lookups import Coded, resolve_coded
from tableflow.session import materialise
from tableflow.sources.catalog import Schema
from tableflow.sources.contracts import Contract
from tableflow.sources.marketplace import MARKETPLACE
from tableflow.sources.tables import seed_frame

# Look-ups of each batch, in order: (table, {batch column: table column}, {table column: name}).
_USER = ("users", {"email": "email"}, {"user_id": "user_id"})
_BUYER = ("buyers", {"user_id": "user_id"}, {"buyer_id": "buyer_id"})
_PRODUCT = ("products", {"product": "name"}, {"product_id": "product_id"})
_ORDER = ("orders", {"order_time": "created_at"}, {"order_id": "order_id"})
LOOKUPS: dict[str, tuple] = {
    "users": (),
    "buyers": (_USER,),
    "sellers": (_USER,),
    "categories": (),
    "products": (("sellers", {"store_name": "store_name"}, {"seller_id": "seller_id"}),),
    "product_categories": (_PRODUCT, ("categories", {"category": "name"},
                                      {"category_id": "category_id"})),
    "orders": (_USER, _BUYER),
    "order_items": (_ORDER, _PRODUCT),
    "payments": (_ORDER,),
    "shipments": (_ORDER,),
    "reviews": (_USER, _BUYER, _PRODUCT),
    "inventory_history": (_PRODUCT,),
    "order_status_history": (_ORDER,),
    "discounts": (_PRODUCT,),
}

# Batch schemas. Times are typed here, so that a text is never compared with a time.
BATCHES = {
    "users": "email string, password_hash string, created_at timestamp_ntz",
    "buyers": "email string, loyalty_points int, membership_level string",
    "sellers": "email string, store_name string, store_description string",
    "categories": "name string",
    "products": "store_name string, name string, price decimal(10,2)",
    "product_categories": "product string, category string",
    "orders": "email string, created_at timestamp_ntz, total_price decimal(12,2)",
    "order_items": "order_time timestamp_ntz, product string, quantity int, "
                   "price_snapshot decimal(10,2)",
    "payments": "order_time timestamp_ntz, amount decimal(12,2), method string",
    "shipments": "order_time timestamp_ntz, address string, shipped_at timestamp_ntz",
    "reviews": "email string, product string, rating int, comment string, "
               "created_at timestamp_ntz",
    "inventory_history": "product string, quantity int, changed_at timestamp_ntz, reason string",
    "order_status_history": "order_time timestamp_ntz, status string, changed_at timestamp_ntz",
    "discounts": "product string, discount_percent decimal(5,2), start_date date, end_date date",
}

# Columns that tell whether a row is in the table already.
KEYS = {
    "users": ("email",),
    "buyers": ("user_id",),
    "sellers": ("user_id",),
    "categories": ("name",),
    "products": ("seller_id", "name"),
    "product_categories": ("product_id", "category_id"),
    "orders": ("buyer_id", "created_at"),
    "order_items": ("order_id", "product_id"),
    "payments": ("order_id", "method", "amount"),
    "shipments": ("order_id",),
    "reviews": ("product_id", "buyer_id"),
    "inventory_history": ("product_id", "changed_at", "reason"),
    "order_status_history": ("order_id", "status", "changed_at"),
    "discounts": ("product_id", "start_date", "end_date"),
}


def empty_tables(spark: SparkSession,
                 contracts: Mapping[str, Contract] = MARKETPLACE) -> dict[str, DataFrame]:
    return {name: seed_frame(spark, [], contract.schema) for name, contract in contracts.items()}


def resolved(tables: Mapping[str, DataFrame], name: str, batch: DataFrame | Coded,
             empty: bool = False) -> DataFrame:
    """The batch with the ids its natural keys stand for. If it will be compared with rows that are
    there it is written out: it is then worked out once, and its size is known."""
    coded = batch if isinstance(batch, Coded) else Coded(batch, {})
    batch = resolve_coded(coded, tables, LOOKUPS[name])
    return materialise(batch, codec="zstd") if LOOKUPS[name] and not empty else batch


def load_table(tables: Mapping[str, DataFrame], name: str, batch: DataFrame | Coded,
               as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Resolve the natural keys of one batch and insert its new rows; return the new table and the
    added rows."""
    empty = tables[name].isEmpty()
    return insert_new(tables[name], resolved(tables, name, batch, empty), MARKETPLACE[name], KEYS[name],
                      as_of, empty)


def levels(names: Iterable[str]) -> list[list[str]]:
    """The tables in steps: those of one step look nothing up in each other."""
    step: dict[str, int] = {}
    for name in LOOKUPS:  # parents come first
        step[name] = 1 + max((step[parent] for parent, _, _ in LOOKUPS[name]), default=0)
    wanted = [name for name in LOOKUPS if name in set(names)]
    return [[name for name in wanted if step[name] == number]
            for number in sorted({step[name] for name in wanted})]


def load(tables: Mapping[str, DataFrame], batches: Mapping[str, DataFrame | Coded],
         as_of: dt.datetime) -> dict[str, DataFrame]:
    """Load the batches, parents first; a later table sees the rows of the earlier ones. The jobs
    of one step are handed to Spark together."""
    tables = dict(tables)
    for names in levels(batches):
        with ThreadPoolExecutor(len(names)) as pool:
            loads = {name: pool.submit(load_table, tables, name, batches[name], as_of)
                     for name in names}
        tables.update({name: done.result()[0] for name, done in loads.items()})
    return tables


def load_schema(schema: Schema, batches: Mapping[str, DataFrame | Coded],
                as_of: dt.datetime) -> dict[str, DataFrame]:
    """The same load into stored tables, which are created if they are absent; return the added rows.

    Each table is appended to by itself, after the audit of its new rows: a bad batch stops the load,
    what was appended before stays, and the next run goes on from there.
    """
    schema.create_missing(MARKETPLACE)
    added = {}
    for names in levels(batches):
        tables = schema.frames()
        with ThreadPoolExecutor(len(names)) as pool:
            loads = {name: pool.submit(schema.insert, MARKETPLACE[name],
                                       resolved(tables, name, batches[name], tables[name].isEmpty()),
                                       KEYS[name], as_of) for name in names}
        added.update({name: done.result() for name, done in loads.items()})
    return added


def backfill_schema(schema: Schema, names: Iterable[str], as_of: dt.date) -> dict[str, int]:
    """``backfill_record_ts`` on stored tables; return the number of rewritten partitions of each."""
    return {name: schema.add_column(name, "record_ts", "date", as_of) for name in names}


def backfill_record_ts(tables: Mapping[str, DataFrame], as_of: dt.date) -> dict[str, DataFrame]:
    """Every table with ``record_ts``: added if absent, its NULLs set to the date."""
    return {name: add_column(df, "record_ts", as_of, "date") for name, df in tables.items()}
