"""Tables in the catalog: creation, appends, rewrites by partition, groups, packing, footprint."""

import datetime as dt
import os
from decimal import Decimal
from urllib.parse import urlparse

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tableflow.plans import rental_changes
from tableflow.plans.bulk import lifecycle
from tableflow.sources.catalog import ContractViolation, Schema
from tableflow.sources.contracts import ID, INT, TEXT, Column, Contract, reference
from tableflow.sources.rental import RENTAL
from tableflow.sources.tables import seed_frame, series

CONTRACTS = {c.name: c for c in (
    Contract("parents", (), primary_key=("p",)),
    Contract("children", (), primary_key=("c",), foreign_keys=(reference("p", "parents"),)))}
MEMBERS = Contract("members", (Column("id", ID), Column("mail", TEXT, length=9), Column("parent", ID, nullable=True),
                               Column("level", INT)), primary_key=("id",), identity="id", uniques=(("mail",),),
                   foreign_keys=(reference("parent", "members", "id"),), checks={"level": "level >= 0"},
                   defaults={"level": 1})
NOW = dt.datetime(2025, 2, 3)


def frames(spark, parents, children):
    return {"parents": seed_frame(spark, [(p,) for p in parents], "p int"),
            "children": seed_frame(spark, children, "c int, p int")}


def state(schema):
    return {name: sorted(tuple(r) for r in df.collect()) for name, df in schema.frames().items()}


def files(schema, name):
    """Paths of the data files with their sizes."""
    return {(row.path, row.length) for row in schema.files(name).collect()}


def in_partition(found, text):
    return {file for file in found if text in file[0]}


# Creating

def test_tables_are_there_by_name(spark, schema):
    schema.create_as("t", spark.range(3))
    assert spark.sql(f"SELECT COUNT(*) FROM {schema.name}.t").first()[0] == 3
    assert schema.location("t").startswith(spark.conf.get("spark.sql.warehouse.dir"))
    assert Schema(spark, schema.name).names() == ["t"]
    with pytest.raises(AnalysisException, match="ALREADY_EXISTS"):
        schema.create_as("t", spark.range(9))
    assert schema.table("t").count() == 3


def test_missing_tables_are_created_once(schema):
    some = {name: RENTAL[name] for name in ("film", "language")}
    assert schema.create_missing(some, {"film": ["rating"]}) == ["film", "language"]
    assert schema.create_missing(some) == []
    film = schema.table("film")
    assert {f.name: f.dataType for f in film.schema} == {c.name: c.type for c in RENTAL["film"].columns}
    assert schema.partition_columns("film") == ["rating"] and schema.partition_columns("language") == []


# Appending

def test_an_insert_appends_only_its_rows(spark, schema):
    schema.create_missing({"members": MEMBERS})
    schema.append("members", series(spark, 1, 1000).repartition(4).selectExpr("x AS id", "CONCAT('m', x) AS mail",
                                                              "NULL AS parent", "1 AS level"))
    before = files(schema, "members")
    batch = seed_frame(spark, [("m7", None), ("a", 5), ("b", None), ("c", 1000)], "mail string, parent long")
    added = schema.insert(MEMBERS, batch, ["mail"], NOW)
    after = files(schema, "members")
    assert before < after and sum(spark.read.parquet(path).count() for path, _ in after - before) == 3
    assert sorted(r.id for r in added.collect()) == [1001, 1002, 1003]
    assert {(r.mail, r.parent, r.level) for r in added.collect()} == {("a", 5, 1), ("b", None, 1), ("c", 1000, 1)}
    assert schema.insert(MEMBERS, batch, ["mail"], NOW).count() == 0
    assert files(schema, "members") == after and schema.table("members").count() == 1003
    assert sorted(r.id for r in added.collect()) == [1001, 1002, 1003]  # ids stay as they were given
    together = seed_frame(spark, [("d", 1005), ("e", 1004)], "mail string, parent long")
    assert schema.insert(MEMBERS, together, ["mail"], NOW).count() == 2


@pytest.mark.parametrize("rows, rules", [
    ([("long enough", None, 1)], {"length mail"}), ([("a", None, -1)], {"check level"}),
    ([("a", 99, 1)], {"reference parent -> members"}), ([("a", None, 1), ("a", None, 2)], {"unique mail"}),
    ([("m1", None, 1)], {"unique mail"}), ([(None, None, None)], {"not null mail", "not null level"})])
def test_a_bad_batch_adds_nothing(spark, schema, rows, rules):
    schema.create_missing({"members": MEMBERS})
    schema.append("members", seed_frame(spark, [(1, "m1", None, 1)], MEMBERS.schema))
    before = files(schema, "members")
    with pytest.raises(ContractViolation) as caught:
        schema.insert(MEMBERS, seed_frame(spark, rows, "mail string, parent long, level int"), ["parent"], NOW)
    assert {v.rule for v in caught.value.violations} == rules
    assert files(schema, "members") == before


def test_the_audit_of_an_insert_reads_keys_of_the_target_only(spark, schema):
    from tableflow.operators.audit import audit_added
    wide = Contract("wide", (Column("k", ID), Column("a", TEXT), Column("b", TEXT)), primary_key=("k",),
                    foreign_keys=(reference("k", "other"),))
    schema.create_missing({"wide": wide, "other": Contract("other", wide.columns)})
    found = audit_added(seed_frame(spark, [(1, "x", "y")], wide.schema), wide, schema.frames())
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<k:bigint>") == plan.count("ReadSchema") >= 2


def test_files_of_created_rewritten_and_appended_tables_are_compressed_alike(schema):
    import pyarrow.parquet as pq
    log = Contract("log", (Column("k", ID), Column("v", TEXT)), primary_key=("k",))
    schema.codec = "zstd"
    schema.create_missing({"log": log})
    schema.insert(log, seed_frame(schema.spark, [(1, "a")], "k long, v string"), ["k"], dt.datetime(2025, 1, 1))
    schema.create_as("bare", seed_frame(schema.spark, [(1,)], "k long"))
    assert schema.add_column("bare", "day", "date", dt.date(2025, 1, 1)) == 1
    for name in ("log", "bare"):
        for file in schema.files(name).collect():
            assert pq.read_metadata(file.path.removeprefix("file:")).row_group(0).column(0).compression == "ZSTD"


def test_a_large_batch_is_shuffled_once_a_rule(spark, schema):
    """Parents that are not larger than the batch are taken whole; old repetitions still do not count."""
    from tableflow.operators.audit import audit_added
    session = spark.newSession()
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    log = Contract("log", (Column("k", ID), Column("p", ID)), uniques=(("k",),), foreign_keys=(reference("p", "top"),))
    top = seed_frame(session, [(1,), (2,)], "p long")
    batch = seed_frame(session, [(5, 1), (6, 2), (6, 9), (7, None)], "k long, p long")
    old = seed_frame(session, [(1, 1), (1, 1), (5, 2)], "k long, p long")
    for whole in ((), ("top",)):
        found = audit_added(batch, log, {"log": old, "top": top}, whole)
        assert {r.rule: (r.violations, r.sample) for r in found.where("violations > 0").collect()} == {
            "unique k": (2, '{"k":5}'), "reference p -> top": (1, '{"p":9}')} | {
            r.rule: (r.violations, r.sample) for r in found.where("violations > 0 AND rule LIKE 'not null%'").collect()}
    cut, plain = (audit_added(batch, log, {"log": old, "top": top}, whole, True)
                  ._jdf.queryExecution().executedPlan().toString().count("Exchange hash") for whole in ((), ("top",)))
    assert plain < cut
    from tableflow.operators.lookups import unseen
    cut, plain = (unseen(batch, old, ["k"], way) for way in (True, False))
    assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hash") == 2
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str) == [
        (6, 2), (6, 9), (7, None)]


def test_columns_are_matched_by_name_when_appended(spark, schema):
    schema.create_as("t", seed_frame(spark, [(1, "a", 5)], "k int, s string, p int"), ["p"])
    schema.append("t", seed_frame(spark, [("b", 6, 2)], "s string, p int, k int"))
    assert state(schema)["t"] == [(1, "a", 5), (2, "b", 6)]


# Changing by partition

@pytest.fixture
def parted(spark, schema):
    rows = spark.range(80).selectExpr("id", "id % 8 AS v", "CAST(NULLIF(id % 8, 7) AS INT) AS p")
    schema.create_as("t", rows.repartition("p"), ["p"])
    return schema


def test_a_delete_rewrites_the_partition_with_the_hits(parted):
    before = files(parted, "t")
    assert parted.delete("t", (F.col("v") == 3) & (F.col("id") > 40)) == 1
    after = files(parted, "t")
    assert before - after == in_partition(before, "p=3/") and len(before & after) == 7
    assert parted.table("t").count() == 75 and parted.table("t").where("p = 3").count() == 5


def test_emptied_and_null_partitions(parted):
    assert parted.delete("t", F.col("p").isNull() | (F.col("p") == 2)) == 2
    assert parted.table("t").count() == 60 and len({r.p for r in parted.table("t").collect()}) == 6
    assert in_partition(files(parted, "t"), "p=2/") == in_partition(files(parted, "t"), "HIVE_DEFAULT") == set()
    assert parted.delete("t", F.col("id") < 0) == 0
    assert parted.delete("t", F.lit(None).cast("boolean")) == 0  # a NULL predicate keeps the row
    assert parted.delete("t", F.lit(True)) == 6 and parted.table("t").count() == 0


def test_partitions_of_two_columns_and_of_text(spark, schema):
    rows = seed_frame(spark, [(i, f"it's {i % 3}", dt.date(2020, 1, 1 + i % 2)) for i in range(12)], "k int, a string, d date")
    schema.create_as("t", rows.coalesce(1), ["a", "d"])
    before = files(schema, "t")
    assert schema.delete("t", (F.col("a") == "it's 1") & (F.col("k") > 3)) == 2
    assert len(before - files(schema, "t")) == 2
    assert sorted(r.k for r in schema.table("t").collect()) == [0, 1, 2, 3, 5, 6, 8, 9, 11]
    assert schema.delete("t", F.col("a") == "it's 1") == 1 or schema.table("t").count() == 8


def test_an_update_rewrites_the_partitions_with_hits(parted):
    before = files(parted, "t")
    changed = parted.update("t", F.col("id").isin(5, 13, 6), {"v": 100})
    assert sorted(tuple(r) for r in changed.collect()) == [(5, 100, 5), (6, 100, 6), (13, 100, 5)]
    assert len(before & files(parted, "t")) == 6
    assert parted.table("t").where("v = 100").count() == 3 and parted.table("t").count() == 80
    with pytest.raises(ValueError):
        parted.update("t", F.col("id") == 1, {"p": 2})


def test_an_update_is_audited(spark, schema):
    schema.create_missing({"members": MEMBERS})
    schema.append("members", seed_frame(spark, [(1, "a", None, 1), (2, "b", 1, 1)], MEMBERS.schema))
    for values, rule in (({"level": -1}, "check level"), ({"mail": "b"}, "unique mail"), ({"parent": 9}, "reference parent -> members")):
        with pytest.raises(ContractViolation) as caught:
            schema.update("members", F.col("id") == 1, values, audited={"members": MEMBERS})
        assert [v.rule for v in caught.value.violations] == [rule]
    schema.update("members", F.col("id") == 1, {"mail": "c", "parent": 2}, audited={"members": MEMBERS})
    assert state(schema)["members"] == [(1, "c", 2, 1), (2, "b", 1, 1)]


def test_rows_that_others_refer_to_are_not_deleted(spark, schema):
    schema.publish(frames(spark, [1, 2], [(1, 1)]), contracts=CONTRACTS)
    with pytest.raises(ContractViolation):
        schema.delete("parents", F.col("p") == 1, CONTRACTS)
    assert schema.delete("children", F.col("p") == 1, CONTRACTS) == 1
    assert schema.delete("parents", F.col("p") == 1, CONTRACTS) == 1
    assert state(schema) == {"parents": [(2,)], "children": []}


def test_a_backfill_rewrites_partitions_with_nulls_only(spark, parted):
    assert parted.add_column("t", "ts", "date", dt.date(2020, 1, 1)) == 8
    before = files(parted, "t")
    assert parted.add_column("t", "ts", "date", dt.date(2021, 1, 1)) == 0 and files(parted, "t") == before
    parted.append("t", seed_frame(spark, [(100, 0, None, 4)], "id long, v long, ts date, p int"))
    before = files(parted, "t")
    assert parted.add_column("t", "ts", "date", dt.date(2021, 1, 1)) == 1
    assert len(before & files(parted, "t")) == 7
    assert {r.ts for r in parted.table("t").where("id = 100").collect()} == {dt.date(2021, 1, 1)}
    assert parted.table("t").where("ts = '2020-01-01'").count() == 80


def test_a_table_without_partitions_is_rewritten_whole(spark, schema):
    schema.create_as("t", spark.range(10))
    assert schema.delete("t", F.col("id") > 99) == 0
    assert schema.delete("t", F.col("id") > 5) == 1 and schema.table("t").count() == 6
    assert schema.add_column("t", "n", "int", 3) == 1
    schema.replace("t", schema.table("t").where("id < 2"))
    assert state(schema) == {"t": [(0, 3), (1, 3)]} and schema.names() == ["t"]


# Groups

def test_group_is_published_whole_or_not_at_all(spark, schema):
    schema.publish(frames(spark, [1, 2], [(1, 1)]), contracts=CONTRACTS)
    before = state(schema)
    with pytest.raises(ContractViolation) as caught:
        schema.publish(frames(spark, [3], [(1, 3), (2, 1)]), contracts=CONTRACTS)
    assert [(v.table_name, v.violations, v.sample) for v in caught.value.violations] == [
        ("children", 1, '{"p":1}')]
    assert state(schema) == before


def test_rows_are_added_to_several_tables_together(spark, schema):
    schema.publish(frames(spark, [1], [(1, 1)]), contracts=CONTRACTS)
    before = files(schema, "children")
    for bad in (frames(spark, [2], [(2, 3)]), frames(spark, [1], []), frames(spark, [2], [(1, 2)]), frames(spark, [2, 2], [])):
        with pytest.raises(ContractViolation):
            schema.publish(added=bad, contracts=CONTRACTS)
    assert files(schema, "children") == before
    schema.publish(added=frames(spark, [2], [(2, 2), (3, 1)]), contracts=CONTRACTS)
    assert before < files(schema, "children")
    assert state(schema) == {"parents": [(1,), (2,)], "children": [(1, 1), (2, 2), (3, 1)]}


def test_parent_change_is_checked_against_unchanged_children(spark, schema):
    schema.publish(frames(spark, [1, 2], [(1, 1)]), contracts=CONTRACTS)
    with pytest.raises(ContractViolation):
        schema.publish({"parents": seed_frame(spark, [(2,)], "p int")}, contracts=CONTRACTS)
    schema.publish({"parents": seed_frame(spark, [(1,)], "p int")}, contracts=CONTRACTS)
    assert state(schema)["parents"] == [(1,)]


def test_failing_job_changes_nothing(spark, schema):
    schema.create_as("t", seed_frame(spark, [(1,)], "k int"))
    bad = schema.table("t").selectExpr("CAST(CONCAT('x', k) AS INT) AS k")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        schema.publish({"u": seed_frame(spark, [(1,)], "k int"), "t": bad})
    assert state(schema) == {"t": [(1,)]}


# Packing and measuring

def test_footprint_compact_truncate(spark, schema):
    schema.create_as("big_table", spark.range(1000).repartition(6))
    schema.create_as("bigger", spark.range(5))
    found = schema.footprint("big_table%").collect()
    folder = urlparse(schema.location("big_table")).path
    sizes = [os.path.getsize(os.path.join(folder, f)) for f in os.listdir(folder) if f.endswith(".parquet")]
    assert [(r.table_name, r.row_count, r.files, r.total_bytes) for r in found] == [
        ("big_table", 1000, 6, sum(sizes))]
    assert found[0].total == f"{sum(sizes)} bytes"
    assert schema.footprint("big_table_").count() == 0
    assert schema.compact("big_table", 64 << 20) == 1 and schema.compact("big_table", 64 << 20) == 0
    row = schema.footprint("big_table").first()
    assert (row.row_count, row.files) == (1000, 1) and row.total_bytes < sum(sizes)
    schema.truncate("big_table")
    assert [(r.row_count, r.files, r.total_bytes) for r in schema.footprint("big_table").collect()] == [(0, 0, 0)]
    assert schema.table("big_table").dtypes == [("id", "bigint")]
    assert schema.table("bigger").count() == 5


def test_compact_leaves_packed_partitions_alone(spark, schema):
    rows = spark.range(4000).selectExpr("id", "id % 3 AS p")
    schema.create_as("t", rows.repartition(1), ["p"])
    schema.append("t", rows.where("p = 1").repartition(5))
    before = files(schema, "t")
    assert schema.compact("t", 64 << 20) == 1
    after = files(schema, "t")
    assert {len(in_partition(after, f"p={p}/")) for p in range(3)} == {1}
    assert before & after == in_partition(before, "p=0/") | in_partition(before, "p=2/")
    assert schema.table("t").where("p = 1").count() == 2 * rows.where("p = 1").count()
    assert schema.compact("t", 1) == 0


def test_bulk_lifecycle(spark, schema):
    after = {r.step: (r.row_count, r.total_bytes)
             for r in lifecycle(schema, "bulk", series(spark, 1, 10_000), "some_22_letter_prefix_").collect()}
    assert {step: rows for step, (rows, _) in after.items()} == {
        "create": 10_000, "delete": 6_667, "compact": 6_667, "truncate": 0}
    assert after["compact"][1] < after["create"][1] and after["truncate"][1] == 0


# The change set, applied to stored tables twice

AS_OF = dt.datetime(2025, 2, 3, 4, 5)
DAY = dt.datetime(2016, 1, 1)


def fill_rental(spark, schema, english=1):
    old, D = dt.date(2006, 1, 1), Decimal
    data = {
        "language": [(i, "English") for i in range(1, english + 1)] + [(9, "French")],
        "film": [(1, "Old Film", 2001, D("1.99"), "PG", 3, 9, old)],
        "category": [], "film_category": [],
        "actor": [(1, "Old", "Actor", old)], "film_actor": [(1, 1, old)],
        "address": [(5, "1 Quay", None), (6, "2 Mill", None)],
        "store": [(4, 5), (3, 6)], "staff": [(8, "S", "T", 3), (7, "S", "T", 4)],
        "customer": [(1, "A", "B", None, 4, 6, 1, old), (2, "C", "D", None, 4, 6, 0, old),
                     (3, "E", "F", None, 4, 6, 0, old)],
        "inventory": [(1, 1, 4, old)],
        "rental": [(i, 1, 2 + i % 2, DAY, 7, old) for i in range(1, 7)] + [(7, 1, 1, DAY, 7, old)],
        "payment": [(i, 2 + i % 2, 7, i, D("1.00"), DAY) for i in range(1, 7)],
    }
    schema.publish({name: seed_frame(spark, data[name], contract.schema)
                    for name, contract in RENTAL.items()}, contracts=RENTAL)
    return schema


def change_set(spark, least=3):
    films = [("North", Decimal("3.20"), 5, "English"), ("South", Decimal("6.75"), 9, "English")]
    return rental_changes.ChangeSet(
        films=seed_frame(spark, films, rental_changes.FILMS),
        actors=seed_frame(spark, [("Vera", "Lund"), ("Old", "Actor")], rental_changes.ACTORS),
        links=seed_frame(spark, [("Vera", "Lund", "North"), ("Old", "Actor", "South"),
                                 ("Old", "Actor", "Old Film"), ("No", "One", "North")],
                         rental_changes.LINKS),
        prices=seed_frame(spark, [(f[0], f[1]) for f in films], "title string, rate decimal(5,2)"),
        customer={"first_name": "Iris", "last_name": "Moor", "email": "iris@example.org", "active": 1},
        least_rentals=least, least_payments=least,
        rental_day=dt.date(2018, 4, 2), payment_day=dt.date(2018, 4, 9))


def test_change_set_and_second_run(spark, schema):
    fill_rental(spark, schema)
    rental_changes.apply(schema, change_set(spark), AS_OF)
    after = state(schema)
    today, day = AS_OF.date(), dt.datetime
    assert sorted(r[0] for r in after["film"]) == [1, 2, 3]
    assert sorted(r[1:4] for r in after["film"]) == [
        ("North", None, Decimal("3.20")), ("Old Film", 2001, Decimal("1.99")),
        ("South", None, Decimal("6.75"))]
    assert len(after["actor"]) == 2 and len(after["film_actor"]) == 3
    assert sorted(r[1:] for r in after["inventory"])[1:] == [(2, 3, today), (3, 3, today)]
    assert after["customer"][1] == (2, "Iris", "Moor", "iris@example.org", 3, 5, 1, today)
    assert {r[2] for r in after["rental"] if r[0] <= 7} == {3, 1}
    new = [r for r in after["rental"] if r[0] > 7]
    assert [r[2:] for r in new] == [(2, day(2018, 4, 2), 7, today)] * 2
    paid = [r for r in after["payment"] if r[5].year == 2018]
    assert sorted((r[1], r[2], r[4], r[5]) for r in paid) == [
        (2, 7, Decimal("3.20"), day(2018, 4, 9)), (2, 7, Decimal("6.75"), day(2018, 4, 9))]
    assert {r[3] for r in paid} == {r[0] for r in new}
    names = ("film", "actor", "film_actor", "inventory")
    before = {name: files(schema, name) for name in names}
    rental_changes.apply(schema, change_set(spark, least=9), AS_OF)  # the history is cleared and rented again
    assert {name: files(schema, name) for name in names} == before
    assert [len(state(schema)[name]) for name in ("rental", "payment")] == [len(after["rental"]), len(after["payment"])]


@pytest.mark.parametrize("english, films", [(0, 0), (2, 4)])
def test_films_per_matching_language(spark, schema, english, films):
    tables = fill_rental(spark, schema, english).frames()
    _, added = rental_changes.add_films(tables, change_set(spark).films, AS_OF)
    assert added.count() == films


def test_nobody_eligible_changes_nobody(spark, schema):
    tables = fill_rental(spark, schema).frames()
    eligible = rental_changes.eligible_customers(tables, 4, 4)
    new, changed = rental_changes.rewrite_customer(tables, eligible, {"active": 1}, AS_OF)
    assert changed.count() == 0
    assert sorted(new.collect()) == sorted(tables["customer"].collect())
    assert sorted(r[0] for r in rental_changes.eligible_customers(tables, 3, 3).collect()) == [2, 3]
    cleared = rental_changes.clear_history(tables, "No", "One")
    assert cleared["payment"].count() == 6 and cleared["rental"].count() == 7
