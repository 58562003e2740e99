"""Queries for the composite jobs: the marketplace load and the film-rental change set."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.operators.audit import audit
from tableflow.plans import marketplace, rental_changes
from tableflow.queries.changes import new_schema, row_counts
from tableflow.queries.registry import register
from tableflow.session import materialise
from tableflow.sources import standin
from tableflow.sources.contracts import DATE, Column, Contract
from tableflow.sources.tables import seed_frame

AS_OF = dt.datetime(2026, 1, 1, 12, 0)


def _loaded(t, names=tuple(marketplace.LOOKUPS)):
    batches = standin.marketplace_batches(t)
    return marketplace.load(marketplace.empty_tables(t.spark),
                            {name: batches[name] for name in names}, AS_OF)


# Marketplace ------------------------------------------------------------------------------------

LOADED_COUNTS = """
WITH bought AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
     sold AS (SELECT DISTINCT l_partkey FROM lineitem)
SELECT 'users' AS table_name, COUNT(*) AS row_count FROM customer
UNION ALL SELECT 'buyers', COUNT(*) FROM customer
UNION ALL SELECT 'sellers', COUNT(*) FROM supplier
UNION ALL SELECT 'categories', COUNT(DISTINCT p_type) FROM part
UNION ALL SELECT 'products', COUNT(*) FROM part WHERE p_partkey IN (SELECT l_partkey FROM sold)
UNION ALL SELECT 'product_categories', COUNT(*) FROM part
          WHERE p_partkey IN (SELECT l_partkey FROM sold)
UNION ALL SELECT 'orders', COUNT(*) FROM orders
UNION ALL SELECT 'order_items', COUNT(*) FROM bought
UNION ALL SELECT 'payments', COUNT(*) FROM orders
UNION ALL SELECT 'shipments', COUNT(*) FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'reviews', COUNT(DISTINCT (o_custkey, l_partkey))
          FROM bought JOIN orders ON o_orderkey = l_orderkey
UNION ALL SELECT 'inventory_history', COUNT(DISTINCT (l_partkey, l_returnflag)) FROM lineitem
UNION ALL SELECT 'order_status_history', COUNT(*) + COUNT(*) FILTER (o_orderstatus = 'F') FROM orders
UNION ALL SELECT 'discounts', COUNT(*) FROM part
          WHERE p_type = 'PROMO' AND p_partkey IN (SELECT l_partkey FROM sold)"""


@register("load_marketplace", "L1 M1 J8 J13 J14 S2 S6 C8 C9 C10", sql=LOADED_COUNTS)
def load_marketplace(t):
    """All 14 tables loaded from the sales tables into empty ones."""
    return row_counts(_loaded(t))


@register("marketplace_items", "L1 J8 J13 C8 C10", sql=f"""
SELECT c_name AS email, o_orderdate AS order_day, p_name || ' ' || p_partkey AS product,
       CAST(SUM(l_quantity) AS INT) AS quantity,
       CAST(MAX(CAST(l_extendedprice AS DECIMAL(10,2))) AS DECIMAL(10,2)) AS price_snapshot,
       DATE '{AS_OF.date()}' AS record_ts
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
     JOIN part ON p_partkey = l_partkey
GROUP BY l_orderkey, c_name, o_orderdate, p_partkey, p_name""")
def marketplace_items(t):
    """Order items with the user, day and product their generated ids lead back to."""
    m = _loaded(t, ("users", "buyers", "sellers", "products", "orders", "order_items"))
    placed = (m["orders"].drop("record_ts")
              .join(m["buyers"].select("buyer_id", "user_id")
                    .join(m["users"].select("user_id", "email"), "user_id"), "buyer_id"))
    return (m["order_items"].join(placed, "order_id")
            .join(m["products"].select("product_id", F.col("name").alias("product")), "product_id")
            .select("email", F.date_trunc("day", "created_at").cast("timestamp_ntz")
                    .alias("order_day"), "product", "quantity", "price_snapshot", "record_ts"))


@register("marketplace_discounts", "L1 C9 F8", sql="""
SELECT p_name || ' ' || p_partkey AS product, CAST(p_size AS DECIMAL(5,2)) AS discount_percent,
       CAST(CAST(p_size AS DECIMAL(5,2)) * CAST(0.01 AS DECIMAL(5,2)) AS DECIMAL(5,2))
       AS discount_fraction
FROM part WHERE p_type = 'PROMO' AND p_partkey IN (SELECT l_partkey FROM lineitem)""")
def marketplace_discounts(t):
    m = _loaded(t, ("users", "sellers", "products", "discounts"))
    return (m["discounts"].join(m["products"].select("product_id", "name"), "product_id")
            .select(F.col("name").alias("product"), "discount_percent", "discount_fraction"))


@register("backfill_record_ts", "L2 M8", sql=f"""
SELECT COUNT(*) AS row_count, COUNT(*) FILTER (o_orderstatus = 'P') AS filled,
       DATE '{AS_OF.date()}' AS newest FROM orders""")
def backfill_record_ts(t):
    """Orders whose load day is unknown for one status, and part of the sales tables without."""
    known = F.when(F.col("o_orderstatus") != "P", F.lit(dt.date(2002, 1, 1)))
    tables = {"orders": t["orders"].withColumn("record_ts", known), "part": t["part"]}
    filled = marketplace.backfill_record_ts(tables, AS_OF.date())["orders"]
    return filled.agg(F.count(F.lit(1)).alias("row_count"),
                      F.count_if(F.col("record_ts") == F.lit(AS_OF.date())).alias("filled"),
                      F.max("record_ts").alias("newest"))


@register("backfill_all_tables", "L2 M8 C1", sql=f"""
SELECT table_name, row_count, 0 AS missing, TRUE AS audited FROM ({LOADED_COUNTS})""")
def backfill_all_tables(t):
    """All 14 tables are stored without their load day, orders with gaps in it. They get
    it; then it is audited that none is missing."""
    schema = new_schema(t, "zstd")
    late = F.when(F.col("total_price") < 1000, F.col("record_ts"))
    for name, df in _loaded(t).items():
        schema.create_as(name, df.withColumn("record_ts", late) if name == "orders" else df.drop("record_ts"))
    marketplace.backfill_schema(schema, schema.names(), AS_OF.date())
    filled = schema.frames()
    loaded_on = {name: Contract(name, (Column("record_ts", DATE, nullable=False),)) for name in filled}
    rules = audit(filled, loaded_on).select("table_name", (F.col("violations") == 0).alias("audited"))
    found = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                    F.count_if(F.col("record_ts").isNull()).cast("int").alias("missing"))
             for name, df in filled.items()]
    return reduce(DataFrame.unionByName, found).join(rules, "table_name")


@register("stored_marketplace", "L1 M1 S6 S8 J8 J13 C10", sql=f"""
SELECT table_name, row_count, CAST(0 AS BIGINT) AS added_again FROM ({LOADED_COUNTS})""")
def stored_marketplace(t):
    """All 14 tables created and loaded in the catalog, and loaded again, which adds nothing."""
    schema, batches = new_schema(t, "zstd"), standin.marketplace_batches(t)
    marketplace.load_schema(schema, batches, AS_OF)
    again = row_counts(marketplace.load_schema(schema, batches, AS_OF)).withColumnRenamed("row_count", "added_again")
    return row_counts(schema.frames()).join(again, "table_name")


# Film-rental change set -------------------------------------------------------------------------

FILMS = (("The Long Harbour", Decimal("2.40"), 4, "ASIA"),
         ("Night Ferry", Decimal("5.85"), 10, "ASIA"),
         ("Paper Lanterns", Decimal("8.10"), 16, "ASIA"))
ACTORS = (("Vera", "Lindqvist"), ("Tomas", "Okafor"), ("Mina", "Castell"))
LINKS = (("Vera", "Lindqvist", "Night Ferry"), ("Tomas", "Okafor", "Night Ferry"),
         ("Mina", "Castell", "Paper Lanterns"), ("Nobody", "Known", "Paper Lanterns"))


def _with_new_films(t):
    tables = standin.rental_tables(t)
    films = seed_frame(t.spark, FILMS, rental_changes.FILMS)
    actors = seed_frame(t.spark, ACTORS, rental_changes.ACTORS)
    tables["film"] = rental_changes.add_films(tables, films, AS_OF)[0]
    tables["actor"] = rental_changes.add_actors(tables, actors, AS_OF)[0]
    return tables, films


@register("add_films_and_actors", "L3 M1 J5 J9 J11 S3 P13", sql="""
WITH known AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
SELECT s_name AS last_name, p_name || ' ' || p_partkey AS title, FALSE AS is_new, TRUE AS in_stock
FROM known JOIN supplier ON s_suppkey = l_suppkey JOIN part ON p_partkey = l_partkey
UNION ALL SELECT 'Lindqvist', 'Night Ferry', TRUE, TRUE
UNION ALL SELECT 'Okafor', 'Night Ferry', TRUE, TRUE
UNION ALL SELECT 'Castell', 'Paper Lanterns', TRUE, TRUE""")
def add_films_and_actors(t):
    """New films, actors, links and items on top of all those of the sales tables; shows every link
    by its names."""
    tables, films = _with_new_films(t)
    links = seed_frame(t.spark, LINKS, rental_changes.LINKS)
    linked, _ = rental_changes.link_actors(tables, links, AS_OF)
    stocked, _ = rental_changes.stock_films(tables, films, AS_OF)
    items = stocked.select("film_id").distinct().withColumn("in_stock", F.lit(True))
    return (linked.join(tables["actor"].select("actor_id", "last_name"), "actor_id")
            .join(tables["film"].select("film_id", "title"), "film_id")
            .join(items, "film_id", "left")
            .select("last_name", "title",
                    (F.col("last_update") == F.lit(AS_OF.date())).alias("is_new"),
                    F.coalesce("in_stock", F.lit(False)).alias("in_stock")))


_FREQUENT = """frequent AS (SELECT MIN(o_custkey) AS chosen FROM
  (SELECT o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
   GROUP BY o_custkey HAVING COUNT(*) >= 10))"""


def _rewritten(t, tables):
    eligible = rental_changes.eligible_customers(tables, 10, 10)
    values = {"first_name": "Iris", "last_name": "Vantongeren", "email": "iris@example.org",
              "active": 1}
    return rental_changes.rewrite_customer(tables, eligible, values, AS_OF)


@register("rewrite_customer", "L4 A4 M2 S7", sql=f"""
WITH {_FREQUENT}
SELECT c_custkey AS customer_id, 'Iris' AS first_name, 'iris@example.org' AS email,
       CAST(0 AS BIGINT) AS store_id, 1 AS active, DATE '{AS_OF.date()}' AS last_update
FROM customer WHERE c_custkey = (SELECT chosen FROM frequent)""")
def rewrite_customer(t):
    return _rewritten(t, standin.rental_tables(t))[1].select(
        "customer_id", "first_name", "email", "store_id", "active", "last_update")


@register("clear_history", "L4 M3", sql=f"""
WITH {_FREQUENT},
left_over AS (SELECT * FROM orders WHERE o_custkey <> (SELECT chosen FROM frequent)
              AND o_orderkey IN (SELECT l_orderkey FROM lineitem))
SELECT 'payment' AS table_name, COUNT(*) AS row_count FROM left_over
UNION ALL SELECT 'rental', COUNT(*) FROM left_over""")
def clear_history(t):
    tables = standin.rental_tables(t)
    tables["customer"] = materialise(_rewritten(t, tables)[0])
    return row_counts(rental_changes.clear_history(tables, "Iris", "Vantongeren"))


@register("rent_and_pay", "L5 J6 J13 S2 M1 F6", sql="""
SELECT c_custkey AS customer_id, title, amount::DECIMAL(5,2) AS amount,
       TIMESTAMP '2018-04-09 00:00:00' AS payment_date, TIMESTAMP '2018-04-02 00:00:00' AS rental_date
FROM customer, (VALUES ('The Long Harbour', 2.40), ('Night Ferry', 5.85), ('Paper Lanterns', 8.10))
     priced(title, amount)
WHERE c_name = 'Customer#000000007'""")
def rent_and_pay(t):
    """A customer rents and pays the new films; shown as the payments that were added."""
    tables, films = _with_new_films(t)
    tables["inventory"] = rental_changes.stock_films(tables, films, AS_OF)[0]
    tables["customer"] = tables["customer"].withColumn("first_name", F.lit("Iris"))
    who = ("Iris", "Customer#000000007")
    rented, _ = rental_changes.rent_films(tables, films, *who, dt.date(2018, 4, 2), AS_OF)
    tables["rental"] = rented
    prices = films.select("title", F.col("rental_rate").alias("rate"))
    _, paid = rental_changes.pay_rentals(tables, prices, *who, dt.date(2018, 4, 9), AS_OF)
    return (paid.join(rented.select("rental_id", "inventory_id", "rental_date"), "rental_id")
            .join(tables["inventory"].select("inventory_id", "film_id"), "inventory_id")
            .join(tables["film"].select("film_id", "title"), "film_id")
            .select("customer_id", "title", "amount", "payment_date", "rental_date"))
