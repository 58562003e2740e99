"""The report questions over film-rental tables.

Each function takes the tables it needs by name and plain parameters. Where two ways of asking one
question give different rows (repeats, zero against NULL, years kept or dropped), each has its own
function. Fact tables are folded to their join key before they are joined, so that a hot key is one
row when it is shuffled. Orderings end in a unique key, so that results are repeatable.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableflow.functions.columns import (
    TOTAL, ascending, conditional_count, descending, descending_nulls_last, two_part_line,
    within_year, years_until)
from tableflow.operators.lookups import count_per_key, only_value

Frames = Mapping[str, DataFrame]


# Films of one category --------------------------------------------------------------------------

def _films_in_range(t: Frames, years: tuple[int, int], above) -> DataFrame:
    return t["film"].where(F.col("release_year").between(*years) & (F.col("rental_rate") > above))


def category_films(t: Frames, category: str, years: tuple[int, int], above) -> DataFrame:
    """A film is listed once for each of its links to the category."""
    wanted = t["category"].where(F.col("name") == category)
    links = t["film_category"].join(wanted, "category_id")
    return (_films_in_range(t, years, above).join(links, "film_id")
            .orderBy(ascending("title"), ascending("film_id"))
            .select("title", "release_year", "rental_rate"))


def category_films_once(t: Frames, category: str, years: tuple[int, int], above) -> DataFrame:
    """A film is listed once; two categories of that name are an error."""
    category_id = only_value(t["category"].where(F.col("name") == category), "category_id")
    links = t["film_category"].where(F.col("category_id") == category_id)
    return (_films_in_range(t, years, above).join(links, "film_id", "left_semi")
            .orderBy(ascending("title"), ascending("film_id"))
            .select("title", "release_year", "rental_rate"))


# Revenue per store ------------------------------------------------------------------------------

def store_revenue(t: Frames, since: dt.date) -> DataFrame:
    """Payments are summed per staff member before the joins: a staff member's payments all go to
    the same address, so the sums add up to the same revenue."""
    per_staff = (t["payment"].where(F.col("payment_date") >= F.lit(since))
                 .groupBy("staff_id").agg(F.sum("amount").alias("amount")))
    placed = (per_staff.join(t["staff"].select("staff_id", "store_id"), "staff_id")
              .join(t["store"], "store_id").join(t["address"], "address_id"))
    return (placed.groupBy("address_id", "address", "address2")
            .agg(F.sum("amount").cast(TOTAL).alias("revenue"))
            .withColumn("full_address", two_part_line("address", "address2"))
            .orderBy(ascending("full_address"), ascending("address_id"))
            .select("full_address", "revenue"))


# Top actors by films ----------------------------------------------------------------------------

def top_actors(t: Frames, since_year: int, k: int) -> DataFrame:
    recent = t["film"].where(F.col("release_year") >= since_year).select("film_id")
    counts = count_per_key(t["film_actor"].join(recent, "film_id"), "actor_id", "number_of_movies")
    return (counts.join(t["actor"], "actor_id")
            .orderBy(descending("number_of_movies"), ascending("actor_id")).limit(k)
            .select("first_name", "last_name", "number_of_movies"))


# Films per year and genre -----------------------------------------------------------------------

def _categorised(t: Frames, categories: DataFrame) -> DataFrame:
    """(release_year, name) per film and category link."""
    links = t["film_category"].join(categories, "category_id")
    return t["film"].select("film_id", "release_year").join(links, "film_id")


def genre_years_long(t: Frames, genres: Sequence[str]) -> DataFrame:
    named = t["category"].where(F.col("name").isin(*genres))
    return (_categorised(t, named).groupBy("release_year", F.col("name").alias("genre"))
            .agg(F.count("film_id").alias("number_of_movies"))
            .orderBy(descending("release_year"), ascending("genre")))


def _genre_columns(genres: Mapping[str, str]):
    return [conditional_count(F.col("name") == genre).alias(column)
            for genre, column in genres.items()]


def genre_years_wide(t: Frames, genres: Mapping[str, str]) -> DataFrame:
    """One column per genre, for years (and the unknown year) with a film of any category."""
    return (_categorised(t, t["category"]).groupBy("release_year").agg(*_genre_columns(genres))
            .orderBy(descending("release_year")))


def genre_years_wide_all(t: Frames, genres: Mapping[str, str]) -> DataFrame:
    """One column per genre, for every year of any film. The unknown year equals no other year,
    so its counts are 0. All genres are counted in one pass."""
    named = t["category"].where(F.col("name").isin(*genres))
    counts = (_categorised(t, named).where(F.col("release_year").isNotNull())
              .groupBy("release_year").agg(*_genre_columns(genres)))
    years = t["film"].select("release_year").distinct()
    return (years.join(counts, "release_year", "left")
            .select("release_year", *[F.coalesce(column, F.lit(0)).alias(column)
                                      for column in genres.values()])
            .orderBy(descending("release_year")))


# Top staff by revenue ---------------------------------------------------------------------------

def _revenue_in_year(t: Frames, year: int) -> DataFrame:
    return (t["payment"].where(within_year("payment_date", year)).groupBy("staff_id")
            .agg(F.sum("amount").cast(TOTAL).alias("total_revenue")))


def top_staff_own_store(t: Frames, year: int, k: int) -> DataFrame:
    """With the staff member's own store. The store of their latest payment is that same store,
    so the payments need not be searched for it."""
    return (_revenue_in_year(t, year).join(t["staff"], "staff_id")
            .orderBy(descending("total_revenue"), ascending("staff_id")).limit(k)
            .select("first_name", "last_name", "store_id", "total_revenue"))


def top_staff_by_last_date(t: Frames, year: int, k: int) -> DataFrame:
    """As above, but a row per payment on the last date, and the limit counts those rows.

    Everybody in the ranking has at least one such row, so only the first ``k`` of it can be shown.
    Only payments of those ``k`` rows are counted for ties. A staff member can fill at most ``k`` rows, so no more repeats than that are made.
    """
    paid = t["payment"].where(within_year("payment_date", year))
    ranked = paid.groupBy("staff_id").agg(F.sum("amount").cast(TOTAL).alias("total_revenue"),
                                          F.max("payment_date").alias("payment_date"))
    order = [descending("total_revenue"), ascending("staff_id")]
    best = ranked.join(t["staff"], "staff_id").orderBy(*order).limit(k)
    last = ["staff_id", "payment_date"]
    ties = (paid.select(*last).join(best.select(*last), last, "left_semi")
            .groupBy(*last).agg(F.count(F.lit(1)).alias("ties")))
    repeats = F.sequence(F.lit(1), F.least("ties", F.lit(k)).cast("int"))
    return (best.join(ties, last).withColumn("_copy", F.explode(repeats))
            .orderBy(*order).limit(k)
            .select("first_name", "last_name", "store_id", "total_revenue"))


def top_staff_rental_store(t: Frames, year: int, k: int) -> DataFrame:
    """With the store of the item rented in the latest payment; NULL if that has no rental.

    Revenue and latest rental come from one pass over the payments. The look-ups cannot change the
    number of rows, so the top ``k`` are taken first and only those are looked up.
    """
    best = (t["payment"].where(within_year("payment_date", year)).groupBy("staff_id")
            .agg(F.sum("amount").cast(TOTAL).alias("total_revenue"),
                 F.max_by("rental_id", F.struct("payment_date", "payment_id")).alias("rental_id"))
            .orderBy(descending("total_revenue"), ascending("staff_id")).limit(k))
    rented = (t["rental"].join(best.select("rental_id"), "rental_id", "left_semi")
              .groupBy("rental_id").agg(F.min("inventory_id").alias("inventory_id")))
    stored = (t["inventory"].join(rented, "inventory_id")
              .select("rental_id", F.col("store_id").alias("last_store_id")))
    return (best.join(stored, "rental_id", "left")
            .orderBy(descending("total_revenue"), ascending("staff_id")).limit(k)
            .select("staff_id", "last_store_id", "total_revenue"))


# Most rented films ------------------------------------------------------------------------------

def _with_audience(films: DataFrame, audience: DataFrame, k: int) -> DataFrame:
    return (films.join(audience, films.rating == F.col("rating_code"), "left")
            .orderBy(descending_nulls_last("number_of_rentals"), ascending("film_id")).limit(k)
            .select("title", "number_of_rentals", F.col("age_group").alias("expected_audience_age")))


def _rentals_per_film(t: Frames) -> DataFrame:
    per_item = count_per_key(t["rental"], "inventory_id", "rentals")
    return (per_item.join(t["inventory"], "inventory_id").groupBy("film_id")
            .agg(F.sum("rentals").alias("number_of_rentals")))


def most_rented(t: Frames, audience: DataFrame, k: int, zero: bool = True) -> DataFrame:
    """Films by rentals with the audience label of their rating. A film never rented has 0
    rentals, or NULL if not ``zero``; a rating without label has NULL."""
    films = t["film"].join(_rentals_per_film(t), "film_id", "left")
    if zero:
        films = films.withColumn("number_of_rentals", F.coalesce("number_of_rentals", F.lit(0)))
    return _with_audience(films, audience, k)


# Years without films ----------------------------------------------------------------------------

def _actor_years(t: Frames) -> DataFrame:
    films = t["film"].select("film_id", "release_year")
    return t["film_actor"].join(films, "film_id").select("actor_id", "release_year")


def inactivity(t: Frames, as_of: dt.date) -> DataFrame:
    """Years from an actor's latest film to the date; NULL, and last, without films."""
    latest = _actor_years(t).groupBy("actor_id").agg(F.max("release_year").alias("latest_year"))
    return (t["actor"].join(latest, "actor_id", "left")
            .select("actor_id", "first_name", "last_name",
                    years_until(as_of, "latest_year").alias("inactivity_years"))
            .orderBy(descending_nulls_last("inactivity_years"), ascending("actor_id")))


def max_gap(t: Frames) -> DataFrame:
    """Largest step between an actor's consecutive film years; 0 with fewer than two years.

    The window sees one row per actor and year, so it is small however many films there are.
    """
    years = _actor_years(t).dropna().distinct()
    following = F.lead("release_year").over(Window.partitionBy("actor_id").orderBy("release_year"))
    gaps = (years.withColumn("gap", following - F.col("release_year"))
            .groupBy("actor_id").agg(F.max("gap").alias("gap")))
    return (t["actor"].join(gaps, "actor_id", "left")
            .select("actor_id", "first_name", "last_name",
                    F.coalesce("gap", F.lit(0)).alias("max_gap_years"))
            .orderBy(descending("max_gap_years"), ascending("actor_id")))
