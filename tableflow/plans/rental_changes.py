"""The change set on the film-rental tables, as seven groups that can each be run again.

Functions on frames return the tables they change; ``apply`` makes the same changes to stored tables,
each group checked before it is put in place. Rows given by hand come as small frames, which name
languages, films, actors and customers by their natural keys. What such rows lead to is small as
well and is written out before it meets a large table, so that Spark knows its size and does not
shuffle the large table for it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.operators.change import delete_rows, update_rows
from tableflow.operators.load import insert_new
from tableflow.operators.lookups import few_keys, first_key, link_by_names, resolve_keys, with_each_key
from tableflow.session import materialise
from tableflow.sources.catalog import Schema
from tableflow.sources.rental import RENTAL

Frames = Mapping[str, DataFrame]
FILMS = "title string, rental_rate decimal(5,2), rental_duration int, language string"
ACTORS = "first_name string, last_name string"
LINKS = "first_name string, last_name string, title string"

# Columns that tell whether a row is in the table already.
KEYS = {
    "film": ("title",),
    "actor": ("first_name", "last_name"),
    "film_actor": ("actor_id", "film_id"),
    "inventory": ("film_id", "store_id"),
    "rental": ("inventory_id", "customer_id"),
    "payment": ("rental_id",),
}


def film_rows(t: Frames, films: DataFrame) -> DataFrame:
    """New films (``FILMS``); an unknown language adds nothing, a language that is there twice adds
    the film twice."""
    return materialise(resolve_keys(films, t["language"], {"language": "name"}, {"language_id": "language_id"}))


def add_films(t: Frames, films: DataFrame, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    return insert_new(t["film"], film_rows(t, films), RENTAL["film"], KEYS["film"], as_of)


def add_actors(t: Frames, actors: DataFrame, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    return insert_new(t["actor"], actors, RENTAL["actor"], KEYS["actor"], as_of)


def link_rows(t: Frames, links: DataFrame) -> DataFrame:
    """Links (``LINKS``) between the actors and films of those names."""
    batch = link_by_names(links, t["actor"].select("actor_id", "first_name", "last_name"),
                          ["first_name", "last_name"],
                          t["film"].select("film_id", "title"), ["title"])
    return materialise(batch.select("actor_id", "film_id"))


def link_actors(t: Frames, links: DataFrame, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    return insert_new(t["film_actor"], link_rows(t, links), RENTAL["film_actor"], KEYS["film_actor"], as_of)


def stock_rows(t: Frames, titles: DataFrame) -> DataFrame:
    """One item of each named film in the first store."""
    return materialise(t["film"].join(titles.select("title").distinct(), "title", "left_semi")
                       .select("film_id", first_key(t["store"], "store_id").alias("store_id")))


def stock_films(t: Frames, titles: DataFrame, as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """The ``stock_rows`` of films that the store does not have."""
    return insert_new(t["inventory"], stock_rows(t, titles), RENTAL["inventory"], KEYS["inventory"], as_of)


def eligible_customers(t: Frames, rentals: int, payments: int) -> DataFrame:
    """Customers with at least so many rentals and payments, each counted on its own table."""
    def enough(rows: DataFrame, key: str, least: int) -> DataFrame:
        return (rows.groupBy("customer_id").agg(F.count_distinct(key).alias("n"))
                .where(F.col("n") >= least))
    return (t["customer"].select("customer_id")
            .join(enough(t["rental"], "rental_id", rentals), "customer_id", "left_semi")
            .join(enough(t["payment"], "payment_id", payments), "customer_id", "left_semi"))


def rewriting(t: Frames, eligible: DataFrame, values: Mapping[str, object],
              as_of: dt.datetime) -> tuple[Column, dict[str, object]]:
    """The first eligible customer as a condition, and its new values with the first store and the
    first address. Nobody is chosen if nobody is eligible."""
    assignments = {**values, "store_id": first_key(t["store"], "store_id"),
                   "address_id": first_key(t["address"], "address_id"),
                   "last_update": as_of.date()}
    return F.col("customer_id") == first_key(eligible, "customer_id"), assignments


def rewrite_customer(t: Frames, eligible: DataFrame, values: Mapping[str, object],
                     as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """Give the first eligible customer new values."""
    return update_rows(t["customer"], *rewriting(t, eligible, values, as_of))


def _named(customers: DataFrame, first_name: str, last_name: str) -> DataFrame:
    return customers.where((F.col("first_name") == first_name) & (F.col("last_name") == last_name))


def first_named(t: Frames, first_name: str, last_name: str) -> Column:
    return first_key(_named(t["customer"], first_name, last_name), "customer_id")


def clear_history(t: Frames, first_name: str, last_name: str) -> dict[str, DataFrame]:
    """Drop the payments and rentals of the first customer of that name."""
    customer = first_named(t, first_name, last_name)
    return {name: delete_rows(t[name], F.col("customer_id") == customer)
            for name in ("payment", "rental")}


def rent_rows(t: Frames, titles: DataFrame, first_name: str, last_name: str, day: dt.date) -> DataFrame:
    """A rental of every item of the named films by each of the few customers of that name, through
    the first staff member."""
    films = resolve_keys(titles.select("title").distinct(), t["film"], {"title": "title"}, {"film_id": "film_id"})
    items = t["inventory"].select("inventory_id", "film_id").join(materialise(films), "film_id")
    batch = with_each_key(items, _named(t["customer"], first_name, last_name), "customer_id")
    return materialise(batch.select("inventory_id", "customer_id", F.lit(day).alias("rental_date"),
                                    first_key(t["staff"], "staff_id").alias("staff_id")))


def rent_films(t: Frames, titles: DataFrame, first_name: str, last_name: str, day: dt.date,
               as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    return insert_new(t["rental"], rent_rows(t, titles, first_name, last_name, day), RENTAL["rental"],
                      KEYS["rental"], as_of)


def pay_rows(t: Frames, prices: DataFrame, first_name: str, last_name: str, day: dt.date) -> DataFrame:
    """A payment (``title, rate``) for each rental of a priced film by the few customers of that
    name. Their rentals are found by their ids, a filter that reaches the scan."""
    takers = few_keys(_named(t["customer"], first_name, last_name), "customer_id")
    rented = materialise(t["rental"].select("rental_id", "inventory_id", "customer_id")
                         .where(F.col("customer_id").isin(takers)))
    films = resolve_keys(prices, t["film"], {"title": "title"}, {"film_id": "film_id"})
    batch = (t["inventory"].select("inventory_id", "film_id").join(rented, "inventory_id")
             .join(films, "film_id")
             .select("customer_id", first_key(t["staff"], "staff_id").alias("staff_id"),
                     "rental_id", F.col("rate").alias("amount"), F.lit(day).alias("payment_date")))
    return materialise(batch)


def pay_rentals(t: Frames, prices: DataFrame, first_name: str, last_name: str, day: dt.date,
                as_of: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """The ``pay_rows`` of rentals that are not paid."""
    return insert_new(t["payment"], pay_rows(t, prices, first_name, last_name, day), RENTAL["payment"],
                      KEYS["payment"], as_of)


@dataclass(frozen=True)
class ChangeSet:
    films: DataFrame         # FILMS
    actors: DataFrame        # ACTORS
    links: DataFrame         # LINKS
    prices: DataFrame        # title, rate
    customer: Mapping[str, object]  # new values, with first_name and last_name
    least_rentals: int
    least_payments: int
    rental_day: dt.date
    payment_day: dt.date


def apply(schema: Schema, change: ChangeSet, as_of: dt.datetime) -> None:
    """Run the seven groups on stored tables. A group that is refused changes nothing and stops the
    run; the groups before it stay. Running all of it again adds no films, actors, links, items,
    rentals or payments that are there."""
    name = (change.customer["first_name"], change.customer["last_name"])

    def insert(table: str, rows: DataFrame) -> None:
        schema.insert(RENTAL[table], rows, KEYS[table], as_of)

    insert("film", film_rows(schema.frames(), change.films))
    insert("actor", change.actors)
    insert("film_actor", link_rows(schema.frames(), change.links))
    insert("inventory", stock_rows(schema.frames(), change.films))
    tables = schema.frames()
    eligible = eligible_customers(tables, change.least_rentals, change.least_payments)
    chosen, assignments = rewriting(tables, eligible, change.customer, as_of)
    schema.update("customer", chosen, assignments, audited=RENTAL)
    customer = first_named(schema.frames(), *name)
    for table in ("payment", "rental"):  # payments first, as they refer to rentals
        schema.delete(table, F.col("customer_id") == customer, RENTAL)
    insert("rental", rent_rows(schema.frames(), change.films, *name, change.rental_day))
    insert("payment", pay_rows(schema.frames(), change.prices, *name, change.payment_day))
