"""Queries for inserts, updates, deletes and stored tables, on the sales tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from tableflow.functions.columns import TOTAL, money
from tableflow.operators.change import cascade_delete, delete_rows, delete_where, update_rows, \
    update_where
from tableflow.operators.load import add_column, assign_ids, insert_new, next_id
from tableflow.operators.lookups import first_key
from tableflow.plans.bulk import lifecycle, numbered_texts, without_thirds
from tableflow.queries.registry import register
from tableflow.session import materialise
from tableflow.sources.catalog import ContractViolation, Schema, footprint
from tableflow.sources.contracts import DATE, ID, TEXT, TODAY, Column, Contract, decimal, reference

LOADED = dt.date(2001, 1, 1)
AS_OF = dt.datetime(2026, 1, 1, 12, 0)
PREFIX = "bulk_row_with_a_prefix"

ORDER_LOG = Contract(
    "order_log",
    (Column("entry_id", ID), Column("order_key", ID), Column("price", decimal(18)),
     Column("state", TEXT), Column("loaded", DATE)),
    primary_key=("entry_id",), identity="entry_id", uniques=(("order_key",),),
    defaults={"state": "new", "loaded": TODAY})


def _order_log(t):
    """Log entries of the orders before a date, and the batch of all orders."""
    batch = t["orders"].select(F.col("o_orderkey").alias("order_key"),
                               money("o_totalprice").alias("price"))
    logged = (t["orders"].where(F.col("o_orderdate") < F.lit(LOADED))
              .select((F.col("o_orderkey") + 1).alias("entry_id"),
                      F.col("o_orderkey").alias("order_key"), money("o_totalprice").alias("price"),
                      F.col("o_orderstatus").alias("state"), F.lit(LOADED).alias("loaded")))
    return logged, batch


def new_schema(t, codec: str | None = None) -> Schema:
    """A schema of its own for each run, in the warehouse of the session."""
    return Schema(t.spark, f"tableflow_{uuid.uuid4().hex}", codec)


# Inserts ----------------------------------------------------------------------------------------

@register("insert_new_rows", "M1 S6 C8 J7", sql=f"""
SELECT o_orderkey AS order_key, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
       CASE WHEN o_orderdate < DATE '{LOADED}' THEN o_orderstatus ELSE 'new' END AS state,
       CASE WHEN o_orderdate < DATE '{LOADED}' THEN DATE '{LOADED}' ELSE DATE '{AS_OF.date()}' END
       AS loaded
FROM orders""")
def insert_new_rows(t):
    logged, batch = _order_log(t)
    new, _ = insert_new(logged, batch, ORDER_LOG, ["order_key"], AS_OF)
    return new.drop("entry_id")


@register("insert_returning", "S7 M1", sql=f"""
SELECT o_orderkey AS order_key, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders
WHERE NOT EXISTS (SELECT 1 FROM orders old WHERE old.o_orderkey = orders.o_orderkey
                  AND old.o_orderdate < DATE '{LOADED}')""")
def insert_returning(t):
    logged, batch = _order_log(t)
    _, added = insert_new(logged, batch, ORDER_LOG, ["order_key"], AS_OF)
    return added.select("order_key", "price")


@register("insert_twice", "M1 S6", sql="""
SELECT COUNT(*) AS row_count, COUNT(DISTINCT o_orderkey) AS order_keys,
       COUNT(DISTINCT o_orderkey) AS entry_ids, CAST(0 AS BIGINT) AS added_again FROM orders""")
def insert_twice(t):
    logged, batch = _order_log(t)
    once, _ = insert_new(logged, batch, ORDER_LOG, ["order_key"], AS_OF)
    twice, again = insert_new(once, batch, ORDER_LOG, ["order_key"], AS_OF)
    return twice.agg(F.count(F.lit(1)).alias("row_count"),
                     F.count_distinct("order_key").alias("order_keys"),
                     F.count_distinct("entry_id").alias("entry_ids"),
                     again.agg(F.count(F.lit(1))).scalar().alias("added_again"))


@register("assign_ids", "C10", sql="""
SELECT (SELECT MAX(o_orderkey) FROM orders) + 1 AS first_id,
       (SELECT MAX(o_orderkey) FROM orders) + COUNT(*) AS last_id, COUNT(*) AS ids FROM lineitem""")
def assign_line_ids(t):
    """Ids for all order lines, after the highest order key: no gaps, no repeats."""
    numbered = assign_ids(t["lineitem"].select("l_partkey"), "id",
                          next_id(t["orders"], "o_orderkey"))
    return numbered.agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"),
                        F.count_distinct("id").alias("ids"))


@register("add_column_backfill", "M8 L2", sql=f"""
SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), 'UNKNOWN') AS segment,
       DATE '{LOADED}' AS record_ts FROM customer""")
def add_column_backfill(t):
    customers = t["customer"].select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING"))
                                     .alias("segment"))
    return add_column(add_column(customers, "segment", "UNKNOWN", "string"),
                      "record_ts", LOADED, "date")


# Updates ----------------------------------------------------------------------------------------

_ELIGIBLE = """
eligible AS (SELECT o_custkey FROM orders GROUP BY o_custkey
             HAVING COUNT(DISTINCT o_orderkey) >= 12 ORDER BY o_custkey LIMIT 1)"""


def _update_first(t):
    """The first customer with many orders gets a new segment, balance and nation."""
    busy = (t["orders"].groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("n"))
            .where("n >= 12"))
    customers = t["customer"].withColumn("c_acctbal", money("c_acctbal"))
    return update_rows(customers, F.col("c_custkey") == first_key(busy, "o_custkey"),
                       {"c_mktsegment": "CHOSEN", "c_acctbal": F.expr("1.50"),
                        "c_nationkey": first_key(t["nation"], "n_nationkey")})


@register("update_selected", "M2 P12 P13", sql=f"""
WITH {_ELIGIBLE}
SELECT c_custkey, c_name,
       CASE WHEN hit THEN (SELECT MIN(n_nationkey) FROM nation) ELSE c_nationkey END AS c_nationkey,
       CASE WHEN hit THEN 1.50 ELSE CAST(c_acctbal AS DECIMAL(18,2)) END::DECIMAL(18,2) AS c_acctbal,
       CASE WHEN hit THEN 'CHOSEN' ELSE c_mktsegment END AS c_mktsegment
FROM (SELECT *, c_custkey = (SELECT o_custkey FROM eligible) AS hit FROM customer)""")
def update_selected(t):
    return _update_first(t)[0]


@register("update_returning", "S7 M2", sql=f"""
WITH {_ELIGIBLE} SELECT o_custkey AS c_custkey FROM eligible""")
def update_returning(t):
    return _update_first(t)[1].select("c_custkey")


@register("update_nothing", "M2 P13", sql="""
SELECT c_custkey, c_mktsegment FROM customer""")
def update_nothing(t):
    """An empty selector changes no row."""
    nobody = t["orders"].where(F.col("o_totalprice") < 0)
    return update_rows(t["customer"].select("c_custkey", "c_mktsegment"),
                       F.col("c_custkey") == first_key(nobody, "o_custkey"),
                       {"c_mktsegment": "CHOSEN"})[0]


@register("update_many", "M2", sql="""
SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)
                       THEN 'LARGE' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def update_many(t):
    large = (t["orders"].where(F.col("o_totalprice") > 450000)
             .select(F.col("o_custkey").alias("c_custkey")))
    return update_where(t["customer"].select("c_custkey", "c_mktsegment"), large, ["c_custkey"],
                        {"c_mktsegment": "LARGE"})[0]


# Deletes ----------------------------------------------------------------------------------------

@register("delete_selected", "M3", sql="""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 5000)""")
def delete_selected(t):
    gone = (t["customer"].where((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 5000))
            .select(F.col("c_custkey").alias("o_custkey")))
    return delete_where(t["orders"].select("o_orderkey", "o_custkey"), gone, ["o_custkey"])


@register("delete_first_selected", "M3 P12 O5", sql="""
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey <> (SELECT c_custkey FROM customer
  WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 1)""")
def delete_first_selected(t):
    building = t["customer"].where(F.col("c_mktsegment") == "BUILDING")
    return delete_rows(t["orders"].select("o_orderkey", "o_custkey"),
                       F.col("o_custkey") == first_key(building, "c_custkey"))


@register("delete_predicate", "M4", sql="""
SELECT p_partkey, NULLIF(p_size, 13) AS size FROM part
WHERE NOT COALESCE(NULLIF(p_size, 13) % 3 = 0, FALSE)""")
def delete_predicate(t):
    sized = t["part"].select("p_partkey", F.nullif("p_size", F.lit(13)).alias("size"))
    return delete_rows(sized, F.col("size") % 3 == 0)


@register("series_delete_third", "P11 M4 F1 F3 F6 F7", sql=f"""
SELECT '{PREFIX}' || o_orderkey AS col FROM orders WHERE NOT (o_orderkey % 3 = 0)""")
def series_delete_third(t):
    """Texts made of the order keys, without those whose number is a multiple of three."""
    return without_thirds(numbered_texts(t["orders"].select(F.col("o_orderkey").alias("x")), PREFIX), PREFIX)


def _keyed(name: str, key: str, *parents: tuple[str, str, str]) -> Contract:
    return Contract(name, (), primary_key=(key,),
                    foreign_keys=tuple(reference(*parent) for parent in parents))


SALES_KEYS = {contract.name: contract for contract in (
    _keyed("nation", "n_nationkey"),
    _keyed("customer", "c_custkey", ("c_nationkey", "nation", "n_nationkey")),
    _keyed("supplier", "s_suppkey", ("s_nationkey", "nation", "n_nationkey")),
    _keyed("orders", "o_orderkey", ("o_custkey", "customer", "c_custkey")),
    _keyed("lineitem", "l_orderkey", ("l_orderkey", "orders", "o_orderkey"),
           ("l_suppkey", "supplier", "s_suppkey")),
)}


@register("cascade_delete", "M9 J7", sql="""
WITH customers AS (SELECT * FROM customer WHERE c_nationkey <> 3),
     suppliers AS (SELECT * FROM supplier WHERE s_nationkey <> 3),
     kept AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customers))
SELECT 'nation' AS table_name, COUNT(*) AS row_count FROM nation WHERE n_nationkey <> 3
UNION ALL SELECT 'customer', COUNT(*) FROM customers
UNION ALL SELECT 'supplier', COUNT(*) FROM suppliers
UNION ALL SELECT 'orders', COUNT(*) FROM kept
UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem
          WHERE l_orderkey IN (SELECT o_orderkey FROM kept)
                AND l_suppkey IN (SELECT s_suppkey FROM suppliers)""")
def cascade_delete_nation(t):
    """One nation goes, with its customers and suppliers, their orders, and the lines of both."""
    tables = {name: t[name] for name in SALES_KEYS}
    gone = t["nation"].where(F.col("n_nationkey") == 3)
    left = cascade_delete(tables, SALES_KEYS, "nation", gone)
    return row_counts(left)


def row_counts(frames):
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count") for name, df in frames.items()]
    first, *rest = parts
    for more in rest:
        first = first.unionByName(more)
    return first


# Stored tables ----------------------------------------------------------------------------------

@register("stored_insert_twice", "M1 S6 C8 C10 S7", sql=f"""
SELECT o_orderkey AS order_key, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
       CASE WHEN o_orderdate < DATE '{LOADED}' THEN o_orderstatus ELSE 'new' END AS state,
       (SELECT COUNT(*) FROM orders WHERE o_orderdate >= DATE '{LOADED}') AS added,
       CAST(0 AS BIGINT) AS added_again, CAST(0 AS BIGINT) AS new_files FROM orders""")
def stored_insert_twice(t):
    """The batch of all orders is appended to the log of some; a second run adds no row and no file."""
    schema, (logged, batch) = new_schema(t), _order_log(t)
    schema.create_missing({"order_log": ORDER_LOG})
    schema.append("order_log", logged)
    added = schema.insert(ORDER_LOG, batch, ["order_key"], AS_OF)
    before = schema.files("order_log").count()
    again = schema.insert(ORDER_LOG, batch, ["order_key"], AS_OF)
    new_files = schema.files("order_log").count() - before
    return schema.table("order_log").select(
        "order_key", "price", "state", added.agg(F.count(F.lit(1))).scalar().alias("added"),
        again.agg(F.count(F.lit(1))).scalar().alias("added_again"), F.lit(new_files).cast("long").alias("new_files"))


@register("create_table_as", "S5", sql="""
SELECT o_custkey, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS spent
FROM orders GROUP BY o_custkey""")
def create_table_as(t):
    schema = new_schema(t)
    schema.create_as("spending", t["orders"].groupBy("o_custkey")
                     .agg(F.sum(money("o_totalprice")).cast(TOTAL).alias("spent")))
    return t.spark.sql(f"SELECT o_custkey, spent FROM {schema.full('spending')}")


@register("create_missing_tables", "S8", sql="""
SELECT 'spending' AS table_name, COUNT(DISTINCT o_custkey) AS row_count FROM orders
UNION ALL SELECT 'order_log', 0""")
def create_missing_tables(t):
    """Of two tables one is there and keeps its rows, the other is made empty."""
    schema = new_schema(t)
    schema.create_as("spending", t["orders"].groupBy("o_custkey").agg(F.sum("o_totalprice").alias("spent")))
    schema.create_missing({"spending": Contract("spending", (Column("o_custkey", ID),)),
                           "order_log": ORDER_LOG})
    return row_counts(schema.frames())


@register("truncate_table", "M5 S5", sql="""
SELECT COUNT(*) AS before, CAST(0 AS BIGINT) AS after, CAST(0 AS BIGINT) AS bytes_after FROM orders""")
def truncate_table(t):
    schema = new_schema(t)
    schema.create_as("orders", t["orders"])
    before = schema.table("orders").count()
    schema.truncate("orders")
    return schema.footprint().select(F.lit(before).cast("long").alias("before"), F.col("row_count").alias("after"),
                                     F.col("total_bytes").cast("long").alias("bytes_after"))


def _orders_by_status(t) -> Schema:
    """A stored copy of the orders, cut by status and priority."""
    schema = new_schema(t)
    orders = t["orders"].select("o_orderkey", "o_custkey", money("o_totalprice").alias("price"), "o_orderdate",
                                "o_orderstatus")
    schema.create_as("orders", orders.repartition("o_orderstatus"), ["o_orderstatus"])
    return schema


@register("stored_delete", "M3 M4", sql="""
SELECT o_orderkey, o_custkey, o_orderstatus,
       (SELECT COUNT(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus <> 'O'
          AND CAST(o_totalprice AS DECIMAL(18,2)) > 300000) AS rewritten FROM orders
WHERE NOT (o_orderstatus <> 'O' AND CAST(o_totalprice AS DECIMAL(18,2)) > 300000)""")
def stored_delete(t):
    """Dear orders that are not open go; the partition of the open ones is not rewritten."""
    schema = _orders_by_status(t)
    rewritten = schema.delete("orders", (F.col("o_orderstatus") != "O") & (F.col("price") > 300000))
    return schema.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                         F.lit(rewritten).cast("long").alias("rewritten"))


@register("stored_update", "M2 S7", sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_custkey % 2 = 0 THEN CAST(1.50 AS DECIMAL(18,2))
                        ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS price,
       (SELECT COUNT(*) FROM orders WHERE o_orderstatus = 'P' AND o_custkey % 2 = 0) AS changed FROM orders""")
def stored_update(t):
    """Orders of one status and of every second customer get a price; one partition is rewritten."""
    schema = _orders_by_status(t)
    changed = schema.update("orders", (F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 2 == 0),
                            {"price": F.expr("1.50")})
    return schema.table("orders").select("o_orderkey", "price",
                                         changed.agg(F.count(F.lit(1))).scalar().alias("changed"))


@register("stored_add_column", "M8 L2", sql=f"""
SELECT o_orderkey, DATE '{LOADED}' AS record_ts, COUNT(*) OVER () AS row_count FROM orders""")
def stored_add_column(t):
    """A column is added to a table of rows, filled, and filled again after rows without it came in."""
    schema = _orders_by_status(t)
    schema.add_column("orders", "record_ts", "date", LOADED)
    late = materialise(schema.table("orders").where("o_orderstatus = 'P'").withColumn("record_ts", F.lit(None).cast("date")))
    schema.delete("orders", F.col("o_orderstatus") == "P")
    schema.append("orders", late)
    schema.add_column("orders", "record_ts", "date", LOADED)
    filled = schema.table("orders")
    return filled.select("o_orderkey", "record_ts", filled.agg(F.count(F.lit(1))).scalar().alias("row_count"))


PACKED_BYTES = 64 << 20


@register("compact_table", "M7", sql="""
SELECT COUNT(*) AS row_count, CAST(SUM(l_quantity) AS BIGINT) AS quantity, TRUE AS packed FROM lineitem""")
def compact_table(t):
    """Lines written in many files, then packed into about as many as their bytes call for."""
    schema = new_schema(t)
    schema.create_as("lines", t["lineitem"].repartition(2 * t.spark.sparkContext.defaultParallelism))
    schema.compact("lines", PACKED_BYTES)
    size = schema.footprint("lines")
    packed = size.select(F.col("files") <= 2 * F.ceil(F.col("total_bytes") / PACKED_BYTES) + 1).scalar()
    return schema.table("lines").agg(F.count(F.lit(1)).alias("row_count"),
                                     F.sum("l_quantity").cast("bigint").alias("quantity"),
                                     packed.alias("packed"))


@register("footprint", "M6 P7 F2 F9", sql=" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, TRUE AS has_bytes FROM {name}"
    for name in ("region", "customer", "supplier", "orders", "lineitem")))
def footprint_of_tables(t):
    """The tables with an e after their first letter, of all seven."""
    tables = {name: (t[name], f"{t.folder}/{name}.parquet") for name in t}
    return footprint(tables, "%_e%").select(
        "table_name", "row_count", (F.col("total_bytes") > 0).alias("has_bytes"))


@register("publish_group", "M10 C3 C4", sql="""
SELECT 'customer' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'orders', COUNT(*) FROM orders""")
def publish_group(t):
    """Customers and part of their orders are put in place together, then the other orders are added.
    Two changes that break a reference are refused, and leave both tables as they were."""
    schema = new_schema(t)
    contracts = {name: SALES_KEYS[name] for name in ("customer", "orders")}
    early = F.col("o_orderdate") < F.lit(LOADED)
    schema.publish({"customer": t["customer"], "orders": t["orders"].where(early)}, contracts=contracts)
    lost = t["orders"].where(~early).withColumn("o_custkey", -F.col("o_custkey"))
    for replaced, added in (({"customer": t["customer"].where("c_mktsegment <> 'BUILDING'"),
                              "orders": t["orders"].where("o_orderstatus <> 'P'")}, {}), ({}, {"orders": lost})):
        try:
            schema.publish(replaced, added, contracts)
        except ContractViolation:
            pass
    schema.publish(added={"orders": t["orders"].where(~early)}, contracts=contracts)
    return row_counts(schema.frames())


@register("bulk_lifecycle", "L6 S5 M4 M5 M6 M7", sql="""
WITH n AS (SELECT COUNT(*) AS all_rows, COUNT(*) FILTER ((l_orderkey * 10 + l_linenumber) % 3 <> 0) AS kept
           FROM lineitem)
SELECT 'create' AS step, all_rows AS row_count FROM n
UNION ALL SELECT 'delete', kept FROM n
UNION ALL SELECT 'compact', kept FROM n
UNION ALL SELECT 'truncate', 0 FROM n""")
def bulk_lifecycle(t):
    """Bulk rows made of the keys of all order lines."""
    numbers = t["lineitem"].select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("x"))
    return lifecycle(new_schema(t), "bulk", numbers, PREFIX).select("step", "row_count")
