"""The report questions on small frames, with the cases in which their variants differ."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tableflow.plans import reports
from tableflow.sources.rental import AUDIENCE
from tableflow.sources.tables import seed_frame


def day(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def t(spark):
    def frame(schema, *rows):
        return seed_frame(spark, rows, schema)
    D = Decimal
    return {
        "film": frame(
            "film_id long, title string, release_year int, rental_rate decimal(5,2), rating string",
            (1, "Alder", 2017, D("2.99"), "G"), (2, "Birch", 2018, D("0.99"), "PG"),
            (3, "Cedar", 2019, D("4.99"), None), (4, "Dogwood", None, D("4.99"), "R"),
            (5, "Elm", 2020, D("3.99"), "NC-17"), (6, "Fir", 2019, D("1.99"), "X")),
        "category": frame("category_id long, name string",
                          (1, "Drama"), (2, "Travel"), (3, "Music")),
        "film_category": frame("film_id long, category_id long",
                               (1, 1), (1, 1), (2, 1), (3, 1), (3, 2), (4, 2), (5, 3)),
        "actor": frame("actor_id long, first_name string, last_name string",
                       (1, "Ann", "Lee"), (2, "Ann", "Lee"), (3, "Bo", "Ray"), (4, "Cy", "Fox")),
        "film_actor": frame("actor_id long, film_id long",
                            (1, 1), (1, 3), (1, 6), (1, 5), (2, 1), (2, 5), (3, 4), (3, 2)),
        "payment": frame(
            "payment_id long, staff_id long, rental_id long, amount decimal(5,2), "
            "payment_date timestamp_ntz",
            (1, 1, 10, D("5.00"), day("2017-01-01")), (2, 1, 11, D("6.00"), day("2017-12-31 23:59")),
            (3, 1, 12, D("7.00"), day("2017-12-31 23:59")), (4, 1, 10, D("9.00"), day("2018-01-01")),
            (5, 2, None, D("8.00"), day("2017-06-01")), (6, 2, 10, D("1.00"), day("2017-05-01")),
            (7, 3, 11, D("2.00"), day("2017-04-01")), (8, 1, 10, D("9.00"), day("2016-12-31"))),
        "staff": frame("staff_id long, first_name string, last_name string, store_id long",
                       (1, "Di", "Orr", 1), (2, "Ed", "Pym", 2), (3, "Flo", "Quin", 3),
                       (4, "Gus", "Rye", 3)),
        "store": frame("store_id long, address_id long", (1, 1), (2, 1), (3, 2)),
        "address": frame("address_id long, address string, address2 string",
                         (1, "1 Quay", "Floor 2"), (2, "2 Mill", None)),
        "inventory": frame("inventory_id long, film_id long, store_id long",
                           (1, 1, 2), (2, 1, 3), (3, 2, 1), (4, 3, 1)),
        "rental": frame("rental_id long, inventory_id long",
                        (10, 1), (11, 2), (12, 3), (13, 1), (14, 3)),
    }


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_category_films_repeats_per_link_and_sorts_by_title(t):
    assert rows(reports.category_films(t, "Drama", (2017, 2019), 1)) == [
        ("Alder", 2017, Decimal("2.99")), ("Alder", 2017, Decimal("2.99")),
        ("Cedar", 2019, Decimal("4.99"))]


def test_category_films_once(t):
    assert [r[0] for r in rows(reports.category_films_once(t, "Drama", (2017, 2019), 1))] == [
        "Alder", "Cedar"]


def test_category_films_once_fails_on_two_categories_of_one_name(t, spark):
    twice = dict(t, category=t["category"].union(t["category"].where("name = 'Drama'")))
    with pytest.raises(Exception, match="SCALAR_SUBQUERY_TOO_MANY_ROWS"):
        reports.category_films_once(twice, "Drama", (2017, 2019), 1).collect()
    assert reports.category_films(twice, "Drama", (2017, 2019), 1).count() == 6


def test_category_films_of_unknown_category(t):
    assert rows(reports.category_films_once(t, "None", (2017, 2019), 1)) == []


def test_store_revenue_merges_stores_of_one_address_and_keeps_the_blank(t):
    assert rows(reports.store_revenue(t, dt.date(2017, 4, 1))) == [
        ("1 Quay Floor 2", Decimal("31.00")), ("2 Mill ", Decimal("2.00"))]


def test_top_actors_keeps_namesakes_apart(t):
    assert rows(reports.top_actors(t, 2015, 2)) == [("Ann", "Lee", 4), ("Ann", "Lee", 2)]


def test_genre_years_long(t):
    found = rows(reports.genre_years_long(t, ("Drama", "Travel")))
    assert found[0] == (None, "Travel", 1)
    assert sorted(found[1:]) == [(2017, "Drama", 2), (2018, "Drama", 1), (2019, "Drama", 1),
                                 (2019, "Travel", 1)]


GENRES = {"Drama": "drama", "Travel": "travel"}


def test_genre_years_wide_has_categorised_years_and_counts_the_unknown_year(t):
    assert rows(reports.genre_years_wide(t, GENRES)) == [
        (None, 0, 1), (2020, 0, 0), (2019, 1, 1), (2018, 1, 0), (2017, 2, 0)]


def test_genre_years_wide_all_has_every_year_and_no_count_for_the_unknown_year(t):
    more = dict(t, film=t["film"].union(t["film"].where("film_id = 6")
                                        .withColumn("release_year", F.lit(1999))))
    assert rows(reports.genre_years_wide_all(more, GENRES)) == [
        (None, 0, 0), (2020, 0, 0), (2019, 1, 1), (2018, 1, 0), (2017, 2, 0), (1999, 0, 0)]


def test_top_staff_own_store(t):
    assert rows(reports.top_staff_own_store(t, 2017, 3)) == [
        ("Di", "Orr", 1, Decimal("18.00")), ("Ed", "Pym", 2, Decimal("9.00")),
        ("Flo", "Quin", 3, Decimal("2.00"))]


def test_top_staff_by_last_date_repeats_ties_before_the_limit(t):
    first = ("Di", "Orr", 1, Decimal("18.00"))
    assert rows(reports.top_staff_by_last_date(t, 2017, 3)) == [
        first, first, ("Ed", "Pym", 2, Decimal("9.00"))]
    assert rows(reports.top_staff_by_last_date(t, 2017, 1)) == [first]


def test_top_staff_rental_store_is_null_without_rental(t):
    assert rows(reports.top_staff_rental_store(t, 2017, 3)) == [
        (1, 1, Decimal("18.00")), (2, None, Decimal("9.00")), (3, 3, Decimal("2.00"))]


def audience(spark):
    return seed_frame(spark, AUDIENCE, "rating_code string, age_group string")


def test_most_rented_with_zero_and_without_label(t, spark):
    assert rows(reports.most_rented(t, audience(spark), 4)) == [
        ("Alder", 3, "All ages"), ("Birch", 2, "Parental guidance suggested"),
        ("Cedar", 0, None), ("Dogwood", 0, "17+")]


def test_most_rented_with_null(t, spark):
    assert rows(reports.most_rented(t, audience(spark), 6, zero=False))[2:] == [
        ("Cedar", None, None), ("Dogwood", None, "17+"), ("Elm", None, "18+"), ("Fir", None, None)]


def test_inactivity_puts_actors_without_films_last(t):
    assert [(r[0], r[3]) for r in rows(reports.inactivity(t, dt.date(2026, 5, 1)))] == [
        (3, 8), (1, 6), (2, 6), (4, None)]


def test_max_gap_skips_equal_years_and_defaults_to_zero(t):
    assert [(r[0], r[3]) for r in rows(reports.max_gap(t))] == [(2, 3), (1, 2), (3, 0), (4, 0)]
