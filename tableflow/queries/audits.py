"""Queries for the contract audits, on sales tables that really break the rules."""

from __future__ import annotations


from pyspark.sql import functions as F

from tableflow.functions.columns import percent_to_fraction
from tableflow.operators.audit import audit
from tableflow.queries.registry import register
from tableflow.sources.contracts import INT, TEXT, TIME, Column, Contract, decimal, reference, text



def _found(tables, *contracts):
    return (audit(tables, {contract.name: contract for contract in contracts})
            .select("table_name", "rule", "violations"))


@register("audit_not_null", "C1 C2", sql="""
SELECT 'part' AS table_name, 'not null p_partkey' AS rule,
       COUNT(*) FILTER (p_partkey IS NULL) AS violations FROM part
UNION ALL SELECT 'part', 'not null size', COUNT(*) FILTER (NULLIF(p_size, 13) IS NULL) FROM part
UNION ALL SELECT 'part', 'unique p_partkey', COUNT(*)
          FROM (SELECT p_partkey FROM part GROUP BY p_partkey HAVING COUNT(*) > 1)""")
def audit_not_null(t):
    sized = t["part"].select("p_partkey", F.nullif("p_size", F.lit(13)).alias("size"))
    contract = Contract("part", (Column("size", INT),), primary_key=("p_partkey",))
    return _found({"part": sized}, contract)


@register("audit_unique", "C3", sql="""
SELECT 'orders' AS table_name, 'unique o_custkey, o_orderdate' AS rule, COUNT(*) AS violations
FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING COUNT(*) > 1)
UNION ALL
SELECT 'lineitem', 'unique l_orderkey, l_linenumber', COUNT(*)
FROM (SELECT 1 FROM lineitem WHERE l_linenumber <> 7 GROUP BY l_orderkey, l_linenumber
      HAVING COUNT(*) > 1)
UNION ALL
SELECT 'lineitem', 'unique l_orderkey', COUNT(*)
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey HAVING COUNT(*) > 1)""")
def audit_unique(t):
    """Keys with a NULL are exempt: line number 7 counts as unknown here."""
    lines = t["lineitem"].select("l_orderkey",
                                 F.nullif("l_linenumber", F.lit(7)).alias("l_linenumber"))
    return _found({"orders": t["orders"], "lineitem": lines},
                  Contract("orders", (), uniques=(("o_custkey", "o_orderdate"),)),
                  Contract("lineitem", (), uniques=(("l_orderkey", "l_linenumber"),
                                                    ("l_orderkey",))))


@register("audit_fk", "C4", sql="""
SELECT 'lineitem' AS table_name, 'reference l_orderkey -> orders' AS rule,
       COUNT(*) FILTER (l_linenumber = 6) AS violations FROM lineitem
UNION ALL
SELECT 'orders', 'reference o_custkey -> customer', COUNT(*) FILTER (o_custkey % 50 = 0) FROM orders""")
def audit_fk(t):
    """Sixth lines and the orders of every fiftieth customer are given keys that nobody has, and the
    fifth customer's orders none."""
    lines = t["lineitem"].withColumn(
        "l_orderkey", F.when(F.col("l_linenumber") == 6, -1 - F.col("l_orderkey")).otherwise(F.col("l_orderkey")))
    key = F.nullif("o_custkey", F.lit(5))
    orders = t["orders"].withColumn("o_custkey", F.when(key % 50 == 0, -1 - key).otherwise(key))
    found = audit(
        {"lineitem": lines, "orders": orders, "customer": t["customer"]},
        {"lineitem": Contract("lineitem", (),
                              foreign_keys=(reference("l_orderkey", "orders", "o_orderkey"),)),
         "orders": Contract("orders", (),
                            foreign_keys=(reference("o_custkey", "customer", "c_custkey"),))})
    return found.select("table_name", "rule", "violations")


@register("audit_check", "C5 C6 C7 P3 P5", sql="""
SELECT 'orders' AS table_name, 'check price floor' AS rule,
       COUNT(*) FILTER (o_totalprice <= 50000) AS violations FROM orders
UNION ALL SELECT 'orders', 'check price range',
       COUNT(*) FILTER (NOT o_totalprice BETWEEN 20000 AND 400000) FROM orders
UNION ALL SELECT 'orders', 'check status', COUNT(*) FILTER (NULLIF(o_orderstatus, 'O') NOT IN ('F'))
FROM orders
UNION ALL SELECT 'lineitem', 'check ends after start',
       COUNT(*) FILTER (l_shipdate <= o_orderdate) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
UNION ALL SELECT 'lineitem', 'check discount', COUNT(*) FILTER (l_discount > 0.09) FROM lineitem""")
def audit_check(t):
    """An unknown status passes, since the check is then neither true nor false."""
    orders = t["orders"].withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("O")))
    lines = t["lineitem"].join(t["orders"].select("o_orderkey", "o_orderdate"),
                               F.col("l_orderkey") == F.col("o_orderkey"))
    return _found({"orders": orders, "lineitem": lines},
                  Contract("orders", (Column("o_orderstatus", TEXT, nullable=True),), checks={
                      "price floor": "o_totalprice > 50000",
                      "price range": "o_totalprice BETWEEN 20000 AND 400000",
                      "status": "o_orderstatus IN ('F')"}),
                  Contract("lineitem", (Column("l_shipdate", TIME, nullable=True),), checks={
                      "ends after start": "l_shipdate > o_orderdate",
                      "discount": "l_discount <= 0.09"}))


@register("audit_length", "C11", sql="""
SELECT 'part' AS table_name, 'length p_name' AS rule,
       COUNT(*) FILTER (LENGTH(p_name) > 10) AS violations FROM part
UNION ALL SELECT 'part', 'type price', COUNT(*) FILTER (p_partkey * 10 >= 10000) FROM part""")
def audit_length(t):
    """Names longer than ten letters, and amounts that need more digits than the column has."""
    priced = t["part"].select("p_name", (F.col("p_partkey") * 10).cast("decimal(18,2)")
                              .alias("price"))
    return _found({"part": priced}, Contract(
        "part", (text("p_name", 10, nullable=True), Column("price", decimal(6), nullable=True))))


@register("audit_computed", "C9", sql="""
SELECT 'part' AS table_name, 'computed fraction' AS rule,
       COUNT(*) FILTER (p_type = 'PROMO') AS violations FROM part""")
def audit_computed(t):
    """Fractions that do not follow from their percent: those of one type are off by one."""
    percent = F.col("p_size").cast("decimal(5,2)")
    off = F.when(F.col("p_type") == "PROMO", percent + F.lit(1)).otherwise(percent)
    parts = t["part"].select(percent.alias("percent"), percent_to_fraction(off).alias("fraction"))
    return _found({"part": parts}, Contract(
        "part", (Column("percent", decimal(5), nullable=True),
                 Column("fraction", decimal(5), nullable=True)),
        computed={"fraction": "percent / 100"}))
