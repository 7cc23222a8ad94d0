"""Dimension builders. A delta passes changed rows as the driver and full tables as lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.calendar import calendar_parts
from martloom.functions.text import region_of
from martloom.operators.merge import last_per_key
from martloom.schema import TARGETS


def _shape(df: DataFrame, target: str) -> DataFrame:
    return df.select(*(F.col(c.name).cast(c.type).alias(c.name) for c in TARGETS[target].columns))


def dim_customers(customers: DataFrame) -> DataFrame:
    return _shape(customers, "dim_customers")


def dim_items(items: DataFrame, categories: DataFrame) -> DataFrame:
    names = categories.select(F.col("id").alias("category_id"), F.col("name").alias("category_name"))
    named = items.select(F.col("id").alias("item_id"), "name", "category_id").join(names, "category_id", "left")
    return _shape(named, "dim_items")


def dim_sizes(sizes: DataFrame) -> DataFrame:
    return _shape(sizes.withColumnRenamed("id", "size_id"), "dim_sizes")


def dim_stores(stores: DataFrame, stores_addresses: DataFrame, addresses: DataFrame) -> DataFrame:
    """One row per store, at its youngest address (then the greatest address id)."""
    at = last_per_key(stores_addresses, ["store_id"], ["created_at", "address_id"]).drop("created_at")
    places = addresses.select(F.col("id").alias("address_id"), "city", "state", "zip_code")
    located = (
        stores.select(F.col("id").alias("store_id"), "name")
        .join(at, "store_id", "left")
        .join(places, "address_id", "left")
        .withColumn("region", region_of(F.col("state")))
    )
    return _shape(located, "dim_stores")


def order_dates(purchases: DataFrame, snapshot_date: dt.date | None = None) -> DataFrame:
    """Distinct order dates, with the snapshot date added when it is missing; a null order date fails the job."""
    missing = F.raise_error(F.lit("a purchase has no valid order date")).cast("date")
    dates = purchases.select(F.coalesce("order_date", missing).alias("date"))
    if snapshot_date is not None:
        day = dates.sparkSession.sql("SELECT * FROM VALUES (:day) AS days(date)", args={"day": snapshot_date})
        dates = dates.unionByName(day)
    return dates.distinct()


def number_dates(dates: DataFrame, start: int = 0) -> DataFrame:
    """dim_time rows numbered by date from ``start + 1``.

    The window has no partitions: it sees one row per calendar day, at most the
    3.7 million days a date column can hold.
    """
    by_date = Window.orderBy("date")
    numbered = dates.select(
        (F.row_number().over(by_date) + F.lit(start)).alias("date_id"), "date", *calendar_parts(F.col("date"))
    )
    return _shape(numbered, "dim_time")


def dim_time(purchases: DataFrame, snapshot_date: dt.date | None = None) -> DataFrame:
    return number_dates(order_dates(purchases, snapshot_date))


def new_dates(existing: DataFrame, purchases: DataFrame, snapshot_date: dt.date | None = None) -> DataFrame:
    """Dates of a delta that dim_time lacks."""
    return order_dates(purchases, snapshot_date).join(existing.select("date"), "date", "left_anti")


def dim_time_additions(
    existing: DataFrame, purchases: DataFrame, snapshot_date: dt.date | None = None
) -> DataFrame:
    """dim_time rows for new dates; numbering goes on after the largest date_id."""
    last = existing.agg(F.coalesce(F.max("date_id"), F.lit(0)).alias("last")).first()["last"]
    return number_dates(new_dates(existing, purchases, snapshot_date), last)
