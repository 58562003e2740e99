"""Contracts of the film-rental tables: the columns the reports and the change jobs use."""

from __future__ import annotations

from tableflow.sources.contracts import (
    DATE, ID, INT, TIME, TODAY, Column, Contract, decimal, reference, text)

RATINGS = ("G", "PG", "PG-13", "R", "NC-17")

# Audience label of each rating (fixed values).
AUDIENCE = (
    ("G", "All ages"),
    ("PG", "Parental guidance suggested"),
    ("PG-13", "13+"),
    ("R", "17+"),
    ("NC-17", "18+"),
)

_UPDATED = Column("last_update", DATE)
_STAMP = {"last_update": TODAY}

RENTAL: dict[str, Contract] = {table.name: table for table in (
    Contract("language", (Column("language_id", ID), text("name")),
             primary_key=("language_id",), identity="language_id"),
    Contract("film", (Column("film_id", ID), text("title"),
                      Column("release_year", INT, nullable=True),
                      Column("rental_rate", decimal(5)), text("rating", nullable=True),
                      Column("rental_duration", INT), Column("language_id", ID), _UPDATED),
             primary_key=("film_id",), identity="film_id", defaults=_STAMP,
             foreign_keys=(reference("language_id", "language"),),
             checks={"rating": f"rating IN ({', '.join(repr(r) for r in RATINGS)})"}),
    Contract("category", (Column("category_id", ID), text("name")),
             primary_key=("category_id",), identity="category_id"),
    Contract("film_category", (Column("film_id", ID), Column("category_id", ID)),
             primary_key=("film_id", "category_id"),
             foreign_keys=(reference("film_id", "film"), reference("category_id", "category"))),
    Contract("actor", (Column("actor_id", ID), text("first_name"), text("last_name"), _UPDATED),
             primary_key=("actor_id",), identity="actor_id", defaults=_STAMP),
    Contract("film_actor", (Column("actor_id", ID), Column("film_id", ID), _UPDATED),
             primary_key=("actor_id", "film_id"), defaults=_STAMP,
             foreign_keys=(reference("actor_id", "actor"), reference("film_id", "film"))),
    Contract("address", (Column("address_id", ID), text("address"),
                         text("address2", nullable=True)),
             primary_key=("address_id",), identity="address_id"),
    Contract("store", (Column("store_id", ID), Column("address_id", ID)),
             primary_key=("store_id",), identity="store_id",
             foreign_keys=(reference("address_id", "address"),)),
    Contract("staff", (Column("staff_id", ID), text("first_name"), text("last_name"),
                       Column("store_id", ID)),
             primary_key=("staff_id",), identity="staff_id",
             foreign_keys=(reference("store_id", "store"),)),
    Contract("customer", (Column("customer_id", ID), text("first_name"), text("last_name"),
                          text("email", nullable=True), Column("store_id", ID),
                          Column("address_id", ID), Column("active", INT, nullable=True),
                          _UPDATED),
             primary_key=("customer_id",), identity="customer_id", defaults=_STAMP,
             foreign_keys=(reference("store_id", "store"), reference("address_id", "address"))),
    Contract("inventory", (Column("inventory_id", ID), Column("film_id", ID),
                           Column("store_id", ID), _UPDATED),
             primary_key=("inventory_id",), identity="inventory_id", defaults=_STAMP,
             foreign_keys=(reference("film_id", "film"), reference("store_id", "store"))),
    Contract("rental", (Column("rental_id", ID), Column("inventory_id", ID),
                        Column("customer_id", ID), Column("rental_date", TIME),
                        Column("staff_id", ID), _UPDATED),
             primary_key=("rental_id",), identity="rental_id", defaults=_STAMP,
             foreign_keys=(reference("inventory_id", "inventory"),
                           reference("customer_id", "customer"),
                           reference("staff_id", "staff"))),
    Contract("payment", (Column("payment_id", ID), Column("customer_id", ID),
                         Column("staff_id", ID), Column("rental_id", ID, nullable=True),
                         Column("amount", decimal(5)), Column("payment_date", TIME)),
             primary_key=("payment_id",), identity="payment_id",
             foreign_keys=(reference("customer_id", "customer"), reference("staff_id", "staff"),
                           reference("rental_id", "rental"))),
)}
