"""Queries for the single operators: scans, predicates, joins, aggregates, sorts, functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tableflow.functions.columns import (
    TOTAL, ascending, conditional_count, descending, descending_nulls_last, money, number_after,
    percent_to_fraction, size_pretty, third_key, two_part_line, within_year, years_until)
from tableflow.operators.lookups import (
    count_per_key, first_key, latest_value, link_by_names, only_value, parents_with_children,
    resolve_keys, with_count, with_each_key, without)
from tableflow.queries.registry import register
from tableflow.session import materialise
from tableflow.sources.tables import seed_frame, series

LATE = dt.date(2001, 6, 1)
AS_OF = dt.date(2026, 1, 1)


# Sources ----------------------------------------------------------------------------------------

ZONES = (("AFRICA", "south"), ("AMERICA", "west"), ("ASIA", "east"), ("EUROPE", "west"))
PRIORITY_DAYS = (("1-URGENT", 1), ("2-HIGH", 3), ("3-MEDIUM", 7))


@register("inline_rows_join", "S2 S1 J1", sql=f"""
SELECT o_orderkey, days FROM orders
JOIN (VALUES {', '.join(str(p) for p in PRIORITY_DAYS)}) promised(priority, days)
     ON priority = o_orderpriority""")
def inline_rows_join(t):
    promised = seed_frame(t.spark, PRIORITY_DAYS, "o_orderpriority string, days int")
    return t["orders"].join(promised, "o_orderpriority").select("o_orderkey", "days")


@register("inline_union_rows", "S3 U1 J1 A2", sql="""
SELECT zone, COUNT(*) AS customers
FROM (SELECT 'AFRICA' AS name, 'south' AS zone UNION ALL SELECT 'AMERICA', 'west'
      UNION ALL SELECT 'ASIA', 'east' UNION ALL SELECT 'EUROPE', 'west') zones
JOIN region ON r_name = name JOIN nation ON n_regionkey = r_regionkey
JOIN customer ON c_nationkey = n_nationkey GROUP BY zone""")
def inline_union_rows(t):
    first, rest = (seed_frame(t.spark, rows, "r_name string, zone string")
                   for rows in (ZONES[:2], ZONES[2:]))
    placed = (first.union(rest).join(t["region"], "r_name")
              .join(t["nation"], F.col("r_regionkey") == F.col("n_regionkey")))
    per_nation = count_per_key(t["customer"], "c_nationkey", "customers")
    return (per_nation.join(placed, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("zone").agg(F.sum("customers").alias("customers")))


@register("series_rows", "S4 J3", sql="""
SELECT x, COALESCE(n, 0) AS orders FROM (SELECT UNNEST(RANGE(0, (SELECT MAX(o_custkey) FROM orders) + 2)) AS x)
LEFT JOIN (SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY ALL) ON o_custkey = x""")
def series_rows(t):
    """Every number up to one past the largest customer key, with how many orders have it."""
    last = t["orders"].agg(F.max("o_custkey").alias("last")).first().last or 0
    return with_count(series(t.spark, 0, last + 1), t["orders"].withColumnRenamed("o_custkey", "x"), "x", "orders")


# Predicates ---------------------------------------------------------------------------------------

@register("scan_filter_project", "S1 P1 P2 P4", sql="""
SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 250000""")
def scan_filter_project(t):
    return (t["orders"].where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000))
            .select(F.col("o_orderkey").alias("order_id"), money("o_totalprice").alias("price")))


@register("between_in_like", "P3 P5 P7", sql="""
SELECT p_partkey, p_name, p_size FROM part
WHERE p_size BETWEEN 5 AND 20 AND p_type IN ('PROMO', 'SMALL', 'LARGE') AND p_name LIKE '%r_ng%'""")
def between_in_like(t):
    return (t["part"].where(F.col("p_size").between(5, 20)
                            & F.col("p_type").isin("PROMO", "SMALL", "LARGE")
                            & F.col("p_name").like("%r_ng%"))
            .select("p_partkey", "p_name", "p_size"))


@register("and_or_nest", "P6 P4", sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
WHERE (l_returnflag = 'R' AND l_quantity >= 45) OR (l_linestatus = 'O' AND l_quantity < 3)
      OR (l_returnflag = 'N' AND l_linestatus = 'F' AND l_quantity = 25)""")
def and_or_nest(t):
    flag, status, quantity = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    wanted = (((flag == "R") & (quantity >= 45)) | ((status == "O") & (quantity < 3))
              | ((flag == "N") & (status == "F") & (quantity == 25)))
    return t["lineitem"].where(wanted).select("l_orderkey", "l_partkey", "l_suppkey",
                                              "l_linenumber", "l_returnflag", "l_linestatus")


@register("is_null_rows", "P8", sql="""
SELECT p_partkey FROM part WHERE NULLIF(p_size, 13) IS NULL""")
def is_null_rows(t):
    return t["part"].where(F.nullif("p_size", F.lit(13)).isNull()).select("p_partkey")


@register("date_range", "P9", sql="""
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= DATE '1998-04-01' AND o_orderdate < DATE '1998-07-01'""")
def date_range(t):
    day = F.col("o_orderdate")
    return (t["orders"].where((day >= F.lit(dt.date(1998, 4, 1))) & (day < F.lit(dt.date(1998, 7, 1))))
            .select("o_orderkey", "o_orderdate"))


@register("year_part", "P10 F4", sql="""
SELECT o_orderkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS order_year FROM orders
WHERE EXTRACT(YEAR FROM o_orderdate) = 1999""")
def year_part(t):
    return (t["orders"].where(within_year("o_orderdate", 1999))
            .select("o_orderkey", F.year("o_orderdate").alias("order_year")))


@register("parsed_suffix", "P11 F3 F6 F7", sql="""
SELECT c_custkey, CAST(REPLACE(c_name, 'Customer#', '') AS BIGINT) AS number FROM customer
WHERE CAST(REPLACE(c_name, 'Customer#', '') AS BIGINT) % 3 = 0""")
def parsed_suffix(t):
    """The predicate of the bulk delete (a third of the numbers), here as a plain filter."""
    number = number_after("c_name", "Customer#")
    return t["customer"].where(number % 3 == 0).select("c_custkey", number.alias("number"))


@register("scalar_compare", "P12", sql="""
SELECT c_custkey, c_name FROM customer
WHERE c_nationkey = (SELECT n_nationkey FROM nation WHERE n_name = 'NATION_7')""")
def scalar_compare(t):
    nation = only_value(t["nation"].where(F.col("n_name") == "NATION_7"), "n_nationkey")
    return t["customer"].where(F.col("c_nationkey") == nation).select("c_custkey", "c_name")


@register("first_key_value", "P13 O5", sql="""
SELECT s_suppkey, (SELECT n_nationkey FROM nation WHERE n_regionkey = 2
                   ORDER BY n_nationkey LIMIT 1) AS home FROM supplier""")
def first_key_value(t):
    home = first_key(t["nation"].where(F.col("n_regionkey") == 2), "n_nationkey")
    return t["supplier"].select("s_suppkey", home.alias("home"))


@register("case_when", "P14", sql="""
SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'large'
                        WHEN o_totalprice >= 100000 THEN 'middle' ELSE 'small' END AS band
FROM orders""")
def case_when(t):
    price = F.col("o_totalprice")
    band = F.when(price >= 300000, "large").when(price >= 100000, "middle").otherwise("small")
    return t["orders"].select("o_orderkey", band.alias("band"))


@register("filtered_before_join", "P15 J1 J22", sql="""
WITH urgent AS (SELECT o_orderkey, o_custkey FROM orders
                WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= DATE '2000-01-01')
SELECT o_orderkey, c_name FROM urgent JOIN customer ON c_custkey = o_custkey""")
def filtered_before_join(t):
    urgent = t["orders"].where((F.col("o_orderpriority") == "1-URGENT")
                               & (F.col("o_orderdate") >= F.lit(dt.date(2000, 1, 1))))
    return (urgent.join(t["customer"], F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_name"))


# Joins ------------------------------------------------------------------------------------------

#: All orders, given to every third customer, so that the others have none.
MOVED = "(SELECT * REPLACE (o_custkey - (o_custkey - 1) % 3 AS o_custkey) FROM orders)"


def _moved_orders(t, key: str = "o_custkey"):
    return t["orders"].withColumn(key, third_key("o_custkey"))


@register("left_join_parents", "J3", sql=f"""
SELECT c_custkey, o_orderkey FROM customer LEFT JOIN {MOVED} ON o_custkey = c_custkey""")
def left_join_parents(t):
    return parents_with_children(t["customer"].select("c_custkey"),
                                 _moved_orders(t, "c_custkey").select("c_custkey", "o_orderkey"),
                                 "c_custkey")


@register("left_join_inline_map", "J4 J19 S2", sql=f"""
SELECT o_orderkey, (SELECT days FROM (VALUES {', '.join(str(p) for p in PRIORITY_DAYS)})
                    promised(priority, days) WHERE priority = o_orderpriority) AS days FROM orders""")
def left_join_inline_map(t):
    promised = seed_frame(t.spark, PRIORITY_DAYS, "o_orderpriority string, days int")
    return t["orders"].join(promised, "o_orderpriority", "left").select("o_orderkey", "days")


@register("cross_one_row", "J5", sql="""
SELECT p_partkey, launched.r_regionkey FROM part
CROSS JOIN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA') launched
WHERE p_retailprice > 0""")
def cross_one_row(t):
    """Every priced part is launched in one named region."""
    priced = t["part"].where(F.col("p_retailprice") > 0).select("p_partkey")
    return with_each_key(priced, t["region"].where(F.col("r_name") == "ASIA"), "r_regionkey")


@register("constant_condition_join", "J6", sql="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, c_custkey FROM lineitem
JOIN part ON p_partkey = l_partkey
JOIN customer ON c_name = 'Customer#000000007' AND c_mktsegment IS NOT NULL
WHERE p_name IN ('red widget', 'blue bolt')""")
def constant_condition_join(t):
    """Lines of two part names, each given to one named customer."""
    named = t["part"].where(F.col("p_name").isin("red widget", "blue bolt")).select("p_partkey")
    buyers = t["customer"].where((F.col("c_name") == "Customer#000000007")
                                 & F.col("c_mktsegment").isNotNull())
    given = with_each_key(named, buyers, "c_custkey")
    return (t["lineitem"].join(given, F.col("l_partkey") == F.col("p_partkey"))
            .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "c_custkey"))


@register("anti_single", "J7", sql=f"""
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM {MOVED})""")
def anti_single(t):
    customers = t["customer"].select("c_custkey", "c_name")
    return without(customers, _moved_orders(t, "c_custkey"), ["c_custkey"])


@register("anti_composite", "J8", sql=f"""
SELECT DISTINCT l_partkey, l_suppkey FROM lineitem fresh
WHERE l_shipdate >= DATE '{LATE}' AND NOT EXISTS
  (SELECT 1 FROM lineitem old WHERE old.l_partkey = fresh.l_partkey
   AND old.l_suppkey = fresh.l_suppkey AND old.l_shipdate < DATE '{LATE}')""")
def anti_composite(t):
    pairs, late = ["l_partkey", "l_suppkey"], F.col("l_shipdate") >= F.lit(LATE)
    fresh = t["lineitem"].where(late).select(*pairs).distinct()
    return without(fresh, t["lineitem"].where(~late), pairs)


@register("anti_scalar_key", "J9 P13", sql="""
SELECT p_partkey, (SELECT MIN(s_suppkey) FROM supplier) AS s_suppkey FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey
                  AND l_suppkey = (SELECT s_suppkey FROM supplier ORDER BY s_suppkey LIMIT 1))""")
def anti_scalar_key(t):
    """Parts the first supplier never shipped, with that supplier's key."""
    batch = t["part"].select("p_partkey", first_key(t["supplier"], "s_suppkey").alias("s_suppkey"))
    shipped = t["lineitem"].select(F.col("l_partkey").alias("p_partkey"),
                                   F.col("l_suppkey").alias("s_suppkey"))
    return without(batch, shipped, ["p_partkey", "s_suppkey"])


@register("semi_in", "J10", sql="""
SELECT o_orderkey, o_custkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 48)""")
def semi_in(t):
    returned = t["lineitem"].where((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 48))
    return (t["orders"].join(returned, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
            .select("o_orderkey", "o_custkey"))


LINKS = (("Customer#000000001", "HOUSEHOLD", "red widget"),
         ("Customer#000000001", "MACHINERY", "blue bolt"),
         ("Customer#000000002", "FURNITURE", "red widget"),
         ("Customer#000000002", "FURNITURE", "small ring"),
         ("Customer#000000007", "BUILDING", "small ring"),
         ("Customer#000000010", "AUTOMOBILE", "blue bolt"))


@register("or_join_mapping", "J11 P6", sql=f"""
SELECT c_custkey, p_partkey FROM customer JOIN part ON
{' OR '.join(f"(c_name = '{n}' AND c_mktsegment = '{s}' AND p_name = '{p}')" for n, s, p in LINKS)}""")
def or_join_mapping(t):
    mapping = seed_frame(t.spark, LINKS, "c_name string, c_mktsegment string, p_name string")
    return (link_by_names(mapping, t["customer"], ["c_name", "c_mktsegment"], t["part"], ["p_name"])
            .select("c_custkey", "p_partkey"))


@register("composite_join", "J12 A5", sql="""
SELECT o.o_orderkey, o.o_custkey FROM orders o
JOIN (SELECT o_custkey, MAX(o_orderdate) AS last_day FROM orders GROUP BY o_custkey) l
     ON l.o_custkey = o.o_custkey AND l.last_day = o.o_orderdate""")
def composite_join(t):
    """All orders of a customer's last order day; two orders on that day both count."""
    last = t["orders"].groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    return (t["orders"].join(last, ["o_custkey", "o_orderdate"])
            .select("o_orderkey", "o_custkey"))


@register("resolve_keys_fanout", "J13 J14", sql="""
SELECT o_orderkey, n_nationkey, notice
FROM (SELECT DISTINCT o_orderdate AS day, o_orderstatus AS notice, 'NATION_4' AS place
      FROM orders WHERE o_orderdate IS NOT NULL) batch
JOIN orders ON o_orderdate = day JOIN nation ON n_name = place""")
def resolve_keys_fanout(t):
    """Daily notices put on every order of that day (the day is no key, so they fan out), with a
    nation given by name. A day has at most one notice per status. The notices are written out, so
    that the orders need not be shuffled if there are few."""
    batch = (t["orders"].where(F.col("o_orderdate").isNotNull())
             .select(F.col("o_orderdate").alias("day"), F.col("o_orderstatus").alias("notice"))
             .distinct())
    placed = with_each_key(batch, t["nation"].where(F.col("n_name") == "NATION_4"), "n_nationkey")
    return (resolve_keys(materialise(placed), t["orders"], {"day": "o_orderdate"},
                         {"o_orderkey": "o_orderkey"})
            .select("o_orderkey", "n_nationkey", "notice"))


@register("correlated_count", "J16 A2 F2", sql=f"""
SELECT c_custkey, (SELECT COUNT(*) FROM {MOVED} WHERE o_custkey = c_custkey) AS orders
FROM customer""")
def correlated_count(t):
    return with_count(t["customer"].select("c_custkey"), _moved_orders(t, "c_custkey"),
                      "c_custkey", "orders")


@register("count_or_null", "J3 A12 J16", sql=f"""
SELECT c_custkey, orders FROM customer LEFT JOIN
  (SELECT o_custkey, COUNT(*) AS orders FROM {MOVED} GROUP BY o_custkey) ON o_custkey = c_custkey""")
def count_or_null(t):
    return with_count(t["customer"].select("c_custkey"), _moved_orders(t, "c_custkey"),
                      "c_custkey", "orders", zero=False)


@register("latest_row_value", "J17", sql=f"""
SELECT c_custkey, last_status FROM customer LEFT JOIN
  (SELECT o_custkey, ARG_MAX(o_orderstatus, (o_orderdate, o_orderkey)) AS last_status
   FROM {MOVED} GROUP BY o_custkey) ON o_custkey = c_custkey""")
def latest_row_value(t):
    last = latest_value(_moved_orders(t), "o_custkey", "o_orderstatus",
                        ["o_orderdate", "o_orderkey"], "last_status")
    return (t["customer"].join(last, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("c_custkey", "last_status"))


@register("correlated_max", "J18 A5 A12", sql=f"""
SELECT c_custkey, (SELECT MAX(o_orderdate) FROM {MOVED} WHERE o_custkey = c_custkey) AS last_day
FROM customer""")
def correlated_max(t):
    last = _moved_orders(t).groupBy("o_custkey").agg(F.max("o_orderdate").alias("last_day"))
    return (t["customer"].join(last, F.col("o_custkey") == F.col("c_custkey"), "left")
            .select("c_custkey", "last_day"))


# Aggregation ------------------------------------------------------------------------------------

@register("sum_by_key", "A1 F6", sql="""
SELECT l_suppkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM lineitem GROUP BY l_suppkey""")
def sum_by_key(t):
    return (t["lineitem"].groupBy("l_suppkey")
            .agg(F.sum(money("l_extendedprice")).cast(TOTAL).alias("revenue")))


@register("count_non_null", "A3 J3", sql=f"""
SELECT c_nationkey, COUNT(o_orderkey) AS orders FROM customer
LEFT JOIN {MOVED} ON o_custkey = c_custkey GROUP BY c_nationkey""")
def count_non_null(t):
    """Orders are counted per customer before the join, so a busy customer is one row in it."""
    counted = with_count(t["customer"].select("c_custkey", "c_nationkey"),
                         _moved_orders(t, "c_custkey"), "c_custkey", "orders", zero=False)
    return counted.groupBy("c_nationkey").agg(F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"))


@register("having_two_distinct", "A4 J10", sql="""
SELECT c_custkey FROM customer JOIN orders r ON r.o_custkey = c_custkey
JOIN (SELECT o_custkey, l_partkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey) p
     ON p.o_custkey = c_custkey
GROUP BY c_custkey
HAVING COUNT(DISTINCT r.o_orderkey) >= 12 AND COUNT(DISTINCT p.l_partkey) >= 43""")
def having_two_distinct(t):
    """Each distinct count is made on its own child, so orders never meet parts per customer."""
    orders = (t["orders"].groupBy("o_custkey").agg(F.count_distinct("o_orderkey").alias("n"))
              .where("n >= 12"))
    bought = t["orders"].join(t["lineitem"], F.col("o_orderkey") == F.col("l_orderkey"))
    parts = (bought.groupBy("o_custkey").agg(F.count_distinct("l_partkey").alias("n"))
             .where("n >= 43"))
    return (t["customer"].join(orders, F.col("c_custkey") == orders["o_custkey"], "left_semi")
            .join(parts, F.col("c_custkey") == parts["o_custkey"], "left_semi")
            .select("c_custkey"))


@register("max_min_by_key", "A5", sql="""
SELECT l_partkey, MIN(l_shipdate) AS first_day, MAX(l_shipdate) AS last_day,
       CAST(MAX(l_extendedprice) AS DECIMAL(18,2)) AS top_price FROM lineitem GROUP BY l_partkey""")
def max_min_by_key(t):
    return t["lineitem"].groupBy("l_partkey").agg(
        F.min("l_shipdate").alias("first_day"), F.max("l_shipdate").alias("last_day"),
        money(F.max("l_extendedprice")).alias("top_price"))


@register("max_difference_default", "A6 F2 F7", sql="""
SELECT c_nationkey, COALESCE(MAX(c_custkey - NULLIF(c_nationkey, 3)), 0) AS widest
FROM customer GROUP BY c_nationkey""")
def max_difference_default(t):
    step = F.col("c_custkey") - F.nullif("c_nationkey", F.lit(3))
    return (t["customer"].groupBy("c_nationkey")
            .agg(F.coalesce(F.max(step), F.lit(0)).alias("widest")))


@register("distinct_years", "A8", sql="""
SELECT CAST(YEAR(l_shipdate) AS INT) AS ship_year FROM lineitem GROUP BY YEAR(l_shipdate)""")
def distinct_years(t):
    return t["lineitem"].select(F.year("l_shipdate").alias("ship_year")).distinct()


@register("pivot_sums", "A9 P14", sql="""
SELECT l_suppkey, CAST(SUM(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS flag_a,
       CAST(SUM(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS flag_n,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS flag_r
FROM lineitem GROUP BY l_suppkey""")
def pivot_sums(t):
    return t["lineitem"].groupBy("l_suppkey").agg(*[
        conditional_count(F.col("l_returnflag") == flag).alias(f"flag_{flag.lower()}")
        for flag in ("A", "N", "R")])


@register("two_column_counts", "A10 A2", sql="""
SELECT l_returnflag, l_linestatus, COUNT(*) AS n FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def two_column_counts(t):
    return t["lineitem"].groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))


@register("arithmetic_over_max", "A11 A5 F4 F5", sql=f"""
SELECT o_custkey, CAST({AS_OF.year} - MAX(YEAR(o_orderdate)) AS INT) AS idle_years
FROM orders GROUP BY o_custkey""")
def arithmetic_over_max(t):
    return (t["orders"].groupBy("o_custkey")
            .agg(years_until(AS_OF, F.max(F.year("o_orderdate"))).alias("idle_years")))


@register("group_with_attributes", "A7 A1 J1", sql="""
SELECT n_nationkey, n_name, COUNT(*) AS suppliers,
       CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS balance
FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY n_nationkey, n_name""")
def group_with_attributes(t):
    """The attributes hang on the key, so they are joined after the aggregate."""
    totals = t["supplier"].groupBy("s_nationkey").agg(
        F.count(F.lit(1)).alias("suppliers"), F.sum(money("s_acctbal")).cast(TOTAL).alias("balance"))
    return (totals.join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
            .select("n_nationkey", "n_name", "suppliers", "balance"))


# Sorts, limits, set operations ------------------------------------------------------------------

@register("order_ascending", "O1", sql="""
SELECT p_partkey, p_name, NULLIF(p_size, 13) AS size FROM part
ORDER BY size ASC NULLS LAST, p_name, p_partkey""")
def order_ascending(t):
    return (t["part"].select("p_partkey", "p_name", F.nullif("p_size", F.lit(13)).alias("size"))
            .orderBy(ascending("size"), ascending("p_name"), ascending("p_partkey")))


@register("top_k_nulls_first", "O2 O4", sql="""
SELECT p_partkey, NULLIF(p_size, 50) AS size FROM part
ORDER BY size DESC NULLS FIRST, p_partkey LIMIT 100""")
def top_k_nulls_first(t):
    return (t["part"].select("p_partkey", F.nullif("p_size", F.lit(50)).alias("size"))
            .orderBy(descending("size"), ascending("p_partkey")).limit(100))


@register("top_k_nulls_last", "O3 O4", sql="""
SELECT p_partkey, NULLIF(p_size, 50) AS size FROM part
ORDER BY size DESC NULLS LAST, p_partkey LIMIT 100""")
def top_k_nulls_last(t):
    return (t["part"].select("p_partkey", F.nullif("p_size", F.lit(50)).alias("size"))
            .orderBy(descending_nulls_last("size"), ascending("p_partkey")).limit(100))


@register("one_row_by_key", "O5", sql="""
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'
ORDER BY c_custkey LIMIT 1""")
def one_row_by_key(t):
    return (t["customer"].where(F.col("c_mktsegment") == "MACHINERY")
            .orderBy(ascending("c_custkey")).limit(1).select("c_custkey", "c_name"))


@register("union_all", "U1", sql="""
SELECT c_nationkey AS nation, c_name AS name FROM customer
UNION ALL SELECT s_nationkey, s_name FROM supplier UNION ALL SELECT n_nationkey, n_name FROM nation""")
def union_all(t):
    sides = ((t["customer"], "c_nationkey", "c_name"), (t["supplier"], "s_nationkey", "s_name"),
             (t["nation"], "n_nationkey", "n_name"))
    first, *rest = [df.select(F.col(key).alias("nation"), F.col(name).alias("name"))
                    for df, key, name in sides]
    for more in rest:
        first = first.unionByName(more)
    return first


# Scalar functions -------------------------------------------------------------------------------

@register("text_functions", "F1 F2 F3", sql="""
SELECT c_custkey, c_name || ' ' || COALESCE(NULLIF(c_mktsegment, 'FURNITURE'), '') AS line,
       c_name || NULLIF(c_mktsegment, 'FURNITURE') AS null_or_line,
       REPLACE(c_name, 'Customer#', '') AS digits FROM customer""")
def text_functions(t):
    segment = F.nullif("c_mktsegment", F.lit("FURNITURE"))
    return t["customer"].select("c_custkey", two_part_line("c_name", segment).alias("line"),
                                F.concat("c_name", segment).alias("null_or_line"),
                                F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("digits"))


@register("date_functions", "F4 F5 F6", sql=f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, DATE '{AS_OF}' AS as_of,
       CAST({AS_OF.year} - EXTRACT(YEAR FROM o_orderdate) AS INT) AS age FROM orders""")
def date_functions(t):
    return t["orders"].select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"),
                              F.lit(AS_OF).alias("as_of"),
                              years_until(AS_OF, F.year("o_orderdate")).alias("age"))


@register("arithmetic", "F7", sql="""
SELECT p_partkey, (p_size - 25) % 3 AS remainder, p_size - 25 AS difference, p_size / 4 AS quotient,
       CAST(POW(2, p_size % 10) AS BIGINT) AS power FROM part""")
def arithmetic(t):
    size = F.col("p_size")
    return t["part"].select("p_partkey", ((size - 25) % 3).alias("remainder"),
                            (size - 25).alias("difference"), (size / 4).alias("quotient"),
                            F.pow(F.lit(2), size % 10).cast("bigint").alias("power"))


@register("computed_fraction", "F8 C9", sql="""
SELECT p_partkey, CAST(CAST(p_size AS DECIMAL(5,2)) + 0.5 AS DECIMAL(5,2)) AS percent,
       CAST(ROUND(CAST(p_size * 100 + 50 AS DECIMAL(10,0)) * CAST(0.0001 AS DECIMAL(5,4)), 2)
            AS DECIMAL(5,2)) AS fraction FROM part""")
def computed_fraction(t):
    """Half percents, so that every fraction has to be rounded up to two places."""
    percent = (F.col("p_size") + F.expr("0.5")).cast("decimal(5,2)")
    return t["part"].select("p_partkey", percent.alias("percent"),
                            percent_to_fraction(percent).alias("fraction"))


@register("readable_sizes", "F9", sql="""
WITH sizes AS (SELECT o_orderkey, CAST(ROUND(o_totalprice) AS BIGINT) * o_orderkey AS b FROM orders)
SELECT o_orderkey, b AS bytes,
       CASE WHEN b < 10240 THEN b || ' bytes'
            WHEN ROUND(b / 1024.0::DOUBLE) < 10240
                 THEN CAST(ROUND(b / 1024.0::DOUBLE) AS BIGINT) || ' kB'
            WHEN ROUND(b / 1048576.0::DOUBLE) < 10240
                 THEN CAST(ROUND(b / 1048576.0::DOUBLE) AS BIGINT) || ' MB'
            WHEN ROUND(b / 1073741824.0::DOUBLE) < 10240
                 THEN CAST(ROUND(b / 1073741824.0::DOUBLE) AS BIGINT) || ' GB'
            ELSE CAST(ROUND(b / 1099511627776.0::DOUBLE) AS BIGINT) || ' TB' END AS size
FROM sizes""")
def readable_sizes(t):
    size = F.round("o_totalprice").cast("bigint") * F.col("o_orderkey")
    return (t["orders"].select("o_orderkey", size.alias("bytes"))
            .withColumn("size", size_pretty("bytes")))
