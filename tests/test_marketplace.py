"""The marketplace load: row counts with fan-out, second load, stored load, contracts."""

import datetime as dt
import re
from decimal import Decimal

import pytest

from tableflow.operators.audit import audit
from tableflow.plans import marketplace
from tableflow.queries import REGISTRY
from tableflow.sources import standin
from tableflow.sources.catalog import ContractViolation
from tableflow.sources.contracts import children_first
from tableflow.sources.marketplace import MARKETPLACE
from tableflow.sources.tables import Tables, seed_frame

AS_OF = dt.datetime(2025, 2, 3, 4, 5)
D = Decimal


def day(text):
    return dt.datetime.fromisoformat(text)


# Two orders share a time; one shipping time and one comment are missing; one stock change is negative.
SHARED, LATER = day("2023-09-17 08:05:30"), day("2023-09-21 19:40:00")
SEEDS = {
    "users": [(f"{name}@example.org", f"hash of {name}", day(joined)) for name, joined in (
        ("ada", "2022-11-02"), ("ben", "2022-12-24"), ("cleo", "2023-02-11"), ("dora", "2023-05-30"))],
    "buyers": [("ben@example.org", 40, "bronze"), ("dora@example.org", 2210, "gold")],
    "sellers": [("ada@example.org", "Kiln & Clay", None), ("cleo@example.org", "Oak Bench", "Furniture")],
    "categories": [("Pottery",), ("Chairs",)],
    "products": [("Kiln & Clay", "Jug", D("18.40")), ("Kiln & Clay", "Bowl", D("7.25")),
                 ("Oak Bench", "Stool", D("64.00")), ("Oak Bench", "Armchair", D("230.10"))],
    "product_categories": [("Jug", "Pottery"), ("Stool", "Chairs"), ("Armchair", "Chairs")],
    "orders": [("dora@example.org", SHARED, D("36.80")), ("ben@example.org", SHARED, D("64.00")),
               ("dora@example.org", LATER, D("14.50"))],
    "order_items": [(LATER, "Bowl", 2, D("7.25")), (SHARED, "Jug", 2, D("18.40"))],
    "payments": [(SHARED, D("36.80"), "PayPal"), (LATER, D("14.50"), "Bank Transfer")],
    "shipments": [(LATER, "Mill Street 4", day("2023-09-23 11:00")), (SHARED, "Quay 9", None)],
    "reviews": [("ben@example.org", "Stool", 2, None, day("2023-10-02")),
                ("dora@example.org", "Bowl", 4, "Neat", day("2023-10-05"))],
    "inventory_history": [("Armchair", 6, day("2023-08-01 07:00"), "Made"),
                          ("Jug", -2, day("2023-09-18 12:00"), "Sold")],
    "order_status_history": [(LATER, "Pending", LATER), (SHARED, "Shipped", day("2023-09-19 16:20"))],
    "discounts": [("Stool", D("12.50"), dt.date(2023, 10, 16), dt.date(2023, 11, 5))],
}
# What is looked up by the shared time lands on both orders.
EXPECTED = {name: len(rows) for name, rows in SEEDS.items()} | {
    name: 3 for name in ("order_items", "payments", "shipments", "order_status_history")}


@pytest.fixture(scope="module")
def batches(spark):
    return {name: seed_frame(spark, SEEDS[name], schema)
            for name, schema in marketplace.BATCHES.items()}


@pytest.fixture(scope="module")
def loaded(spark, batches):
    return marketplace.load(marketplace.empty_tables(spark), batches, AS_OF)


def test_counts(loaded):
    counts = {name: df.count() for name, df in loaded.items()}
    assert counts == EXPECTED
    assert sum(counts.values()) == 37


def test_no_violations(loaded):
    found = audit(loaded, MARKETPLACE)
    assert found.count() > 100
    assert found.where("violations > 0").collect() == []


def test_second_load_adds_nothing(batches, loaded):
    for name in marketplace.LOOKUPS:
        new, added = marketplace.load_table(loaded, name, batches[name], AS_OF)
        assert added.count() == 0, name
        assert new.count() == EXPECTED[name]


def carrying(df, column):
    """Number of shuffles in the plan that carry the column."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return len(re.findall(rf"\) Exchange *\nInput[^\n]*\b{column}#", plan))


@pytest.fixture
def large(spark):
    """A session in which every table is too large to be broadcast."""
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return session


def test_order_lines_are_not_shuffled_by_their_natural_keys(large):
    t = Tables(large, "/root/testdata/sf0.001")
    batches = standin.marketplace_batches(t)
    tables = {
        "users": t["customer"].selectExpr("c_custkey AS user_id", "c_name AS email"),
        "buyers": t["customer"].selectExpr("c_custkey AS user_id", "c_custkey AS buyer_id"),
        "orders": t["orders"].selectExpr("o_orderkey AS order_id", "o_orderdate AS created_at"),
        "products": t["part"].selectExpr("p_partkey AS product_id", "p_name AS name")}
    assert carrying(marketplace.resolved(tables, "order_items", batches["order_items"], True), "quantity") == 1
    assert carrying(marketplace.resolved(tables, "reviews", batches["reviews"], True), "rating") == 2


def test_items_are_shuffled_once_an_id(large):
    items = REGISTRY["marketplace_items"](large, "/root/testdata/sf0.001")
    assert carrying(items, "price_snapshot") == 2


def test_values(loaded):
    assert sorted((r.discount_percent, r.discount_fraction) for r in loaded["discounts"].collect()) \
        == [(D("12.50"), D("0.13"))]
    assert {r.record_ts for r in loaded["users"].collect()} == {AS_OF.date()}
    assert {r.joined_date for r in loaded["sellers"].collect()} == {AS_OF.date()}
    assert sorted(r.order_item_id for r in loaded["order_items"].collect()) == [1, 2, 3]
    assert [r.delivered_at for r in loaded["shipments"].collect()] == [None] * 3
    assert sum(r.shipped_at is None for r in loaded["shipments"].collect()) == 2
    assert [tuple(f.dataType.simpleString() for f in df.schema) for df in loaded.values()] == \
        [tuple(c.type.simpleString() for c in MARKETPLACE[n].columns) for n in loaded]


def test_stored_load_twice(batches, schema):
    """All 14 tables; the second run adds no row and no file."""
    added = marketplace.load_schema(schema, batches, AS_OF)
    assert {name: rows.count() for name, rows in added.items()} == EXPECTED
    assert audit(schema.frames(), MARKETPLACE).where("violations > 0").collect() == []
    files = {name: schema.files(name).collect() for name in EXPECTED}
    first = {name: sorted(schema.table(name).collect(), key=str) for name in EXPECTED}
    again = marketplace.load_schema(schema, batches, AS_OF)
    assert sum(rows.count() for rows in again.values()) == 0
    assert {name: schema.files(name).collect() for name in EXPECTED} == files
    assert {name: sorted(schema.table(name).collect(), key=str) for name in EXPECTED} == first


def test_bad_batch_is_refused(spark, batches, schema):
    marketplace.load_schema(schema, {"users": batches["users"]}, AS_OF)
    bad = seed_frame(spark, [("ada@example.org", -1, "platinum")], marketplace.BATCHES["buyers"])
    with pytest.raises(ContractViolation) as caught:
        marketplace.load_schema(schema, {"buyers": bad}, AS_OF)
    assert {v.rule for v in caught.value.violations} == {"check loyalty_points",
                                                         "check membership_level"}
    assert schema.table("buyers").count() == 0


def test_stored_backfill(spark, batches, schema):
    marketplace.load_schema(schema, {"users": batches["users"]}, AS_OF)
    schema.create_as("bare", schema.table("users").drop("record_ts"))
    assert marketplace.backfill_schema(schema, ["users", "bare"], dt.date(2026, 1, 1)) == {"users": 0, "bare": 1}
    assert {r.record_ts for r in schema.table("bare").collect()} == {dt.date(2026, 1, 1)}


def test_copies_in_one_batch_are_left_to_the_audit(spark, batches):
    tables = marketplace.empty_tables(spark)
    twice = batches["users"].union(batches["users"])
    tables["users"], added = marketplace.load_table(tables, "users", twice, AS_OF)
    assert added.count() == 8
    found = audit({"users": tables["users"]}, MARKETPLACE).where("violations > 0").collect()
    assert [(v.rule, v.violations) for v in found] == [("unique email", 4)]


def test_backfill(spark, loaded):
    tables = {"users": loaded["users"].drop("record_ts"), "buyers": loaded["buyers"]}
    filled = marketplace.backfill_record_ts(tables, dt.date(2026, 1, 1))
    assert {r.record_ts for r in filled["users"].collect()} == {dt.date(2026, 1, 1)}
    assert {r.record_ts for r in filled["buyers"].collect()} == {AS_OF.date()}


def test_children_come_before_parents():
    order = children_first(MARKETPLACE)
    for name, contract in MARKETPLACE.items():
        for key in contract.foreign_keys:
            assert order.index(name) < order.index(key.parent)
    assert len(order) == 14
