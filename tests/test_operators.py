"""Look-ups, inserts, updates, deletes, audits and column functions on small frames."""

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tableflow.functions.columns import (
    ascending, descending, number_after, percent_to_fraction, size_pretty, two_part_line)
from tableflow.operators.audit import audit
from tableflow.operators.change import cascade_delete, delete_rows, update_rows, update_where
from tableflow.operators.load import add_column, assign_ids, insert_new
from tableflow.operators import lookups
from tableflow.operators.lookups import first_key, link_by_names, only_value, resolve_keys, unseen
from tableflow.plans.reports import max_gap
from tableflow.sources.contracts import (
    DATE, ID, INT, NOW, TIME, TODAY, Column, Contract, decimal, reference, text)
from tableflow.sources.tables import seed_frame, series

AS_OF = dt.datetime(2025, 2, 3, 4, 5)
SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


# Look-ups

def test_resolve_keys_drops_unknown_and_repeats_for_several(spark):
    batch = seed_frame(spark, [("a", 1), ("b", 2), (None, 3)], "name string, v int")
    dim = seed_frame(spark, [("a", 10), ("a", 11), (None, 12)], "name string, id long")
    assert rows(resolve_keys(batch, dim, {"name": "name"}, {"id": "name_id"})) == [(1, 10), (1, 11)]


def test_coded_rows_are_resolved_like_their_natural_keys(spark):
    """A code without a name, one with two names, a name without an id and one with two ids."""
    rows_ = seed_frame(spark, [(1, 7, "p"), (2, 7, "q"), (3, 8, "r"), (4, 9, "s"), (None, 7, "t"), (1, 8, "u")],
                       "c int, d int, v string")
    users = seed_frame(spark, [(1, "ann"), (2, "bea"), (2, "cid"), (4, "eve")], "c int, email string")
    goods = seed_frame(spark, [(7, "jug"), (8, "cup")], "d int, product string")
    dims = {"users": seed_frame(spark, [("ann", 10), ("bea", 20), ("cid", 30), ("cid", 31)], "email string, user_id int"),
            "buyers": seed_frame(spark, [(10, 100), (20, 200), (30, 300)], "user_id int, buyer_id int"),
            "goods": seed_frame(spark, [("jug", 70), ("cup", 80), ("cup", 81)], "name string, good_id int")}
    steps = (("users", {"email": "email"}, {"user_id": "user_id"}),
             ("buyers", {"user_id": "user_id"}, {"buyer_id": "buyer_id"}),
             ("goods", {"product": "name"}, {"good_id": "good_id"}))
    joined = rows_.join(users, "c").join(goods, "d").drop("c", "d")
    coded = lookups.resolve_coded(lookups.Coded(rows_, {"c": users, "d": goods}), dims, steps)
    for dim, on, take in steps:
        joined = resolve_keys(joined, dims[dim], on, take)
    assert sorted(coded.columns) == sorted(joined.columns)
    assert rows(coded.select("v", "buyer_id", "good_id")) == rows(joined.select("v", "buyer_id", "good_id"))
    assert coded.count() == 5


@pytest.mark.parametrize("languages, films", [(0, 0), (1, 2), (2, 4)])
def test_lookup_in_place_of_a_cross_join(spark, languages, films):
    batch = seed_frame(spark, [("x", "English"), ("y", "English")], "title string, language string")
    dim = seed_frame(spark, [(i, "English") for i in range(languages)], "id long, name string")
    assert resolve_keys(batch, dim, {"language": "name"}, {"id": "id"}).count() == films


def test_unseen_ignores_null_keys_and_keeps_copies(spark):
    batch = seed_frame(spark, [(1, "a"), (1, None), (2, "b"), (2, "b")], "k int, s string")
    target = seed_frame(spark, [(1, "a"), (1, "a"), (1, None)], "k int, s string")
    assert rows(unseen(batch, target, ["k", "s"])) == [(1, None), (2, "b"), (2, "b")]


def test_scalars(spark):
    frame = seed_frame(spark, [(3,), (1,), (2,)], "k int")
    one = spark.range(1)
    assert one.select(first_key(frame, "k")).first()[0] == 1
    assert one.select(first_key(frame.where("k > 9"), "k")).first()[0] is None
    assert one.select(only_value(frame.where("k = 2"), "k")).first()[0] == 2
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        one.select(only_value(frame, "k")).collect()


def test_link_by_names(spark):
    mapping = seed_frame(spark, [("a", "t"), ("a", "u"), ("z", "t")], "name string, title string")
    left = seed_frame(spark, [(1, "a"), (2, "a"), (3, "b")], "lid int, name string")
    right = seed_frame(spark, [(7, "t"), (8, "u"), (9, "v")], "rid int, title string")
    linked = link_by_names(mapping, left, ["name"], right, ["title"]).select("lid", "rid")
    assert rows(linked) == [(1, 7), (1, 8), (2, 7), (2, 8)]


# Inserts

NOTES = Contract(
    "notes", (Column("id", ID), text("name", 5), Column("points", INT, nullable=True),
              Column("at", TIME), Column("share", decimal(5), nullable=True), Column("on", DATE)),
    primary_key=("id",), identity="id", uniques=(("name",),),
    defaults={"points": 7, "at": NOW, "on": TODAY}, computed={"share": "points / 100"},
    checks={"points": "points >= 0"})


def test_insert_fills_absent_columns_only_and_continues_ids(spark):
    target = seed_frame(spark, [(41, "old", 1, AS_OF, Decimal("0.01"), AS_OF.date())], NOTES.schema)
    given_null = seed_frame(spark, [("a", None)], "name string, points int")
    new, added = insert_new(target, given_null, NOTES, ["name"], AS_OF)
    assert rows(added) == [(42, "a", None, AS_OF, None, AS_OF.date())]
    absent = seed_frame(spark, [("b",), ("old",)], "name string")
    newer, added = insert_new(new, absent, NOTES, ["name"], AS_OF)
    assert rows(added) == [(43, "b", 7, AS_OF, Decimal("0.07"), AS_OF.date())]
    assert newer.count() == 3


def test_default_time_does_not_depend_on_the_time_zone(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    target = seed_frame(session, [], NOTES.schema)
    _, added = insert_new(target, seed_frame(session, [("a",)], "name string"), NOTES, ["name"], AS_OF)
    assert [(r["at"], r["on"]) for r in added.collect()] == [(AS_OF, AS_OF.date())]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_assign_ids_has_no_gaps(spark, parts):
    numbered = assign_ids(series(spark, 1, 1000).repartition(parts), "id", 501)
    assert sorted(r.id for r in numbered.collect()) == list(range(501, 1501))
    assert rows(numbered.select("x")) == rows(series(spark, 1, 1000))


def test_assign_ids_keeps_columns_named_like_those_of_files(spark):
    frame = series(spark, 1, 9).selectExpr("x AS file_name", "x AS row_index", "x AS _part").repartition(3)
    assert sorted(r.id for r in assign_ids(frame, "id").collect()) == list(range(1, 10))


def test_assign_ids_of_nothing(spark):
    assert assign_ids(series(spark, 1, 0), "id").count() == 0


@SLOW
@given(st.lists(st.sampled_from("abcdef"), max_size=8), st.sets(st.sampled_from("abcdef")))
def test_insert_twice_equals_once(spark, names, old):
    target = seed_frame(spark, [(i, name, 1, AS_OF, None, AS_OF.date())
                                for i, name in enumerate(sorted(old), 1)], NOTES.schema)
    batch = seed_frame(spark, [(name,) for name in names], "name string")
    once, added = insert_new(target, batch, NOTES, ["name"], AS_OF)
    twice, again = insert_new(once, batch, NOTES, ["name"], AS_OF)
    assert sorted(r.name for r in added.collect()) == sorted(n for n in names if n not in old)
    assert again.count() == 0
    assert rows(twice) == rows(once)


def test_add_column(spark):
    frame = seed_frame(spark, [(1, None), (2, 5)], "k int, v int")
    assert rows(add_column(frame, "v", 9, "int")) == [(1, 9), (2, 5)]
    assert rows(add_column(frame.drop("v"), "v", 9, "int")) == [(1, 9), (2, 9)]


# Updates and deletes

def test_update_rows_keeps_others_and_recomputes(spark):
    frame = seed_frame(spark, [(1, "a", 10, AS_OF, Decimal("0.10"), AS_OF.date()),
                               (2, "b", None, AS_OF, None, AS_OF.date())], NOTES.schema)
    new, changed = update_rows(frame, F.col("points") == 10, {"points": 30}, NOTES)
    assert rows(changed) == [(1, "a", 30, AS_OF, Decimal("0.30"), AS_OF.date())]
    assert rows(new)[1] == (2, "b", None, AS_OF, None, AS_OF.date())


def test_update_where_with_repeated_selector(spark):
    frame = seed_frame(spark, [(1, "a"), (2, "b")], "k int, s string")
    chosen = seed_frame(spark, [(2,), (2,), (9,)], "k int")
    new, changed = update_where(frame, chosen, ["k"], {"s": "new"})
    assert rows(new) == [(1, "a"), (2, "new")]
    assert rows(changed) == [(2, "new")]


def test_delete_rows_keeps_unknown(spark):
    frame = seed_frame(spark, [(3,), (4,), (None,)], "k int")
    assert rows(delete_rows(frame, F.col("k") % 3 == 0)) == [(4,), (None,)]


SHOP = {c.name: c for c in (
    Contract("users", (), primary_key=("u",)),
    Contract("orders", (), primary_key=("o",), foreign_keys=(reference("u", "users"),)),
    Contract("products", (), primary_key=("p",), foreign_keys=(reference("u", "users"),)),
    Contract("items", (), primary_key=("i",),
             foreign_keys=(reference("o", "orders"), reference("p", "products"))),
    Contract("notes", (), primary_key=("n",), foreign_keys=(reference("i", "items"),)),
    Contract("other", (), primary_key=("x",)),
)}


def shop(spark, seed=0):
    def frame(schema, *values):
        return seed_frame(spark, values, schema)
    return {
        "users": frame("u int", (1,), (2,), (3,)),
        "orders": frame("o int, u int", (10, 1), (11, 2), (12, None)),
        "products": frame("p int, u int", (20, 2), (21, 3)),
        "items": frame("i int, o int, p int", (30, 10, 21), (31, 11, 21), (32, 12, 20), (33, 12, 21)),
        "notes": frame("n int, i int", (40, 30), (41, 31), (42, 32), (43, 33)),
        "other": frame("x int", (1,)),
    }


def test_cascade_reaches_a_table_by_two_references(spark):
    tables = shop(spark)
    left = cascade_delete(tables, SHOP, "users", seed_frame(spark, [(2,), (2,)], "u int"))
    assert {name: rows(df) for name, df in left.items()} == {
        "users": [(1,), (3,)], "orders": [(10, 1), (12, None)], "products": [(21, 3)],
        "items": [(30, 10, 21), (33, 12, 21)], "notes": [(40, 30), (43, 33)]}


@SLOW
@given(st.sets(st.integers(1, 3)))
def test_cascade_leaves_no_orphans(spark, gone):
    tables = shop(spark)
    left = {**tables, **cascade_delete(tables, SHOP, "users",
                                       seed_frame(spark, [(u,) for u in gone], "u int"))}
    broken = audit(left, SHOP).where("violations > 0 AND rule LIKE 'reference%'")
    assert broken.collect() == []


# Audits: one offender per rule

def test_each_rule_finds_its_offender(spark):
    contract = Contract(
        "goods", (Column("id", ID), text("name", 4), Column("price", decimal(4)),
                  Column("grade", INT, nullable=True), Column("starts", DATE, nullable=True),
                  Column("ends", DATE, nullable=True), Column("part", decimal(5), nullable=True),
                  Column("owner", ID, nullable=True)),
        primary_key=("id",), uniques=(("name", "grade"),),
        foreign_keys=(reference("owner", "owners", "id"),),
        checks={"price": "price >= 0", "grade": "grade IN (1, 2)", "dates": "ends > starts"},
        computed={"part": "grade / 100"})
    d, part = dt.date, {g: Decimal(g) / 100 for g in (1, 2, 3)}
    goods = seed_frame(spark, [
        (1, "ok", Decimal("1.00"), 1, d(2024, 1, 1), d(2024, 1, 2), part[1], 5),
        (1, "also", Decimal("1.00"), 2, None, d(2024, 1, 2), part[2], None),
        (3, None, Decimal("1.00"), None, None, None, None, None),
        (4, "longer", Decimal("1.00"), 1, None, None, part[1], None),
        (5, "big", Decimal("100.00"), 1, None, None, part[1], None),
        (6, "neg", Decimal("-1.00"), 1, None, None, part[1], None),
        (7, "odd", Decimal("1.00"), 3, None, None, part[3], None),
        (8, "date", Decimal("1.00"), 1, d(2024, 1, 2), d(2024, 1, 2), part[1], None),
        (9, "part", Decimal("1.00"), 1, None, None, part[2], None),
        (10, "own", Decimal("1.00"), 1, None, None, part[1], 6),
        (11, "own", Decimal("1.00"), 1, None, None, part[1], 6),
        (12, "nul", Decimal("1.00"), None, None, None, None, None),
        (13, "nul", Decimal("1.00"), None, None, None, None, None),
    ], "id long, name string, price decimal(10,2), grade int, starts date, ends date, "
       "part decimal(5,2), owner long")
    owners = seed_frame(spark, [(5,)], "id long")
    found = {r.rule: (r.violations, r.sample) for r in
             audit({"goods": goods, "owners": owners}, {"goods": contract}).collect()}
    assert {rule: f for rule, f in found.items() if f[0]} == {
        "not null name": (1, '{"id":3}'), "length name": (1, '{"id":4}'),
        "type price": (1, '{"id":5}'), "check price": (1, '{"id":6}'),
        "check grade": (1, '{"id":7}'), "check dates": (1, '{"id":8}'),
        "computed part": (1, '{"id":9}'), "unique id": (1, '{"id":1}'),
        "unique name, grade": (1, '{"name":"own","grade":1}'),
        "reference owner -> owners": (2, '{"owner":6}')}
    assert found["not null id"] == (0, None)


# Column functions

def test_two_part_line_keeps_the_blank(spark):
    frame = seed_frame(spark, [("a", "b"), ("a", None), (None, "b")], "x string, y string")
    assert [r[0] for r in frame.select(two_part_line("x", "y")).collect()] == ["a b", "a ", None]


def test_null_order(spark):
    frame = seed_frame(spark, [(1,), (None,), (2,)], "k int")
    assert [r.k for r in frame.orderBy(ascending("k")).collect()] == [1, 2, None]
    assert [r.k for r in frame.orderBy(descending("k")).collect()] == [None, 2, 1]


def test_size_pretty(spark):
    sizes = {0: "0 bytes", 8192: "8192 bytes", 10239: "10239 bytes", 10240: "10 kB",
             10485247: "10239 kB", 10485248: "10 MB", 401580032: "383 MB", 602505216: "575 MB",
             10 << 30: "10 GB", 10 << 40: "10 TB", 10 << 50: "10 PB"}
    frame = seed_frame(spark, [(b,) for b in sizes], "b long")
    assert {r[0]: r[1] for r in frame.select("b", size_pretty("b")).collect()} == sizes


def test_fraction_rounds_half_up(spark):
    frame = seed_frame(spark, [(Decimal("10.00"),), (Decimal("10.55"),), (Decimal("0.50"),)],
                       "p decimal(5,2)")
    assert [r[0] for r in frame.select(percent_to_fraction("p")).collect()] == [
        Decimal("0.10"), Decimal("0.11"), Decimal("0.01")]


def test_number_after_fails_on_other_text(spark):
    frame = seed_frame(spark, [("x12",), ("y",)], "s string")
    assert frame.where("s = 'x12'").select(number_after("s", "x")).first()[0] == 12
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        frame.select(number_after("s", "x")).collect()


# Largest gap against its self-join definition

@SLOW
@given(st.lists(st.tuples(st.integers(1, 3), st.one_of(st.none(), st.integers(2000, 2008))),
                max_size=14))
def test_max_gap_equals_brute_force(spark, films):
    frames = {
        "actor": seed_frame(spark, [(i, "f", "l") for i in (1, 2, 3, 4)],
                            "actor_id long, first_name string, last_name string"),
        "film_actor": seed_frame(spark, [(a, i) for i, (a, _) in enumerate(films)],
                                 "actor_id long, film_id long"),
        "film": seed_frame(spark, [(i, y) for i, (_, y) in enumerate(films)],
                           "film_id long, release_year int"),
    }
    expected = {}
    for actor in (1, 2, 3, 4):
        years = [y for a, y in films if a == actor and y is not None]
        steps = [min(z for z in years if z > y) - y for y in years if any(z > y for z in years)]
        expected[actor] = max(steps, default=0)
    assert {r.actor_id: r.max_gap_years for r in max_gap(frames).collect()} == expected


def test_unknown_batch_column_is_refused(spark):
    target = seed_frame(spark, [], NOTES.schema)
    with pytest.raises(ValueError, match="nmae"):
        insert_new(target, seed_frame(spark, [("a", "b")], "name string, nmae string"), NOTES, ["name"], AS_OF)


def test_reference_to_an_absent_table_is_reported(spark):
    child = Contract("child", (), foreign_keys=(reference("p", "absent"),))
    found = audit({"child": seed_frame(spark, [(1,)], "p int")}, {"child": child}).collect()
    assert [(r.rule, r.violations) for r in found] == [("reference p -> absent", None)]


def test_left_join_as_two_and_keys_of_named_rows(spark):
    parents = seed_frame(spark, [(1,), (2,), (None,)], "k int")
    children = seed_frame(spark, [(1, "a"), (1, "b"), (3, "c"), (None, "d")], "k int, v string")
    found = lookups.parents_with_children(parents, children, "k").collect()
    assert sorted(map(str, found)) == sorted(map(str, parents.join(children, "k", "left").collect()))
    for keys in ([], [7], [7, 8]):
        named = seed_frame(spark, [(k,) for k in keys], "x int")
        assert lookups.with_each_key(parents.where("k > 0"), named, "x").count() == 2 * len(keys)


def test_rows_with_each_of_a_few_keys(spark):
    rows, keys = seed_frame(spark, [(1,), (2,)], "r int"), [5, 6, 7]
    chosen = seed_frame(spark, [(k,) for k in keys], "k int")
    for n in (0, 1, 3):
        found = lookups.with_each_key(rows, chosen.where(F.col("k") < 5 + n), "k", most=3)
        assert sorted(tuple(r) for r in found.collect()) == [(r, k) for r in (1, 2) for k in keys[:n]]
        assert found.dtypes == [("r", "int"), ("k", "int")]
    with pytest.raises(lookups.TooManyRows):
        lookups.with_each_key(rows, chosen, "k", most=2)
