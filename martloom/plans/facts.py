"""Fact builders, the same for a full load and a delta."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.schema import TARGETS


def line_value(price: Column, quantity: Column) -> Column:
    """Price times quantity as double."""
    return price.cast("double") * quantity


def dated_purchases(purchases: DataFrame, dim_time: DataFrame, complete: bool = False) -> DataFrame:
    """Purchases with their ``date_id`` and ``year``.

    By default a purchase whose date is not in dim_time drops out. With
    ``complete`` such a purchase fails the job instead. dim_time has one row per
    calendar day, which bounds what is broadcast.
    """
    days = F.broadcast(dim_time.select(F.col("date").alias("order_date"), "date_id", "year"))
    dated = purchases.withColumnRenamed("id", "purchase_id")
    if not complete:
        return dated.join(days, "order_date")
    missing = F.raise_error(F.concat(F.lit("no date_id for order date "), F.col("order_date").cast("string")))
    return dated.join(days, "order_date", "left").withColumn(
        "date_id", F.when(F.col("date_id").isNull(), missing.cast("int")).otherwise(F.col("date_id"))
    )


def with_status(purchases: DataFrame, status: DataFrame) -> DataFrame:
    return purchases.join(status.select("purchase_id", F.col("status").alias("purchase_status")), "purchase_id")


def with_lines(purchases: DataFrame, lines: DataFrame) -> DataFrame:
    return purchases.join(
        lines.select("purchase_id", "item_id", "size_id", F.col("quantity").alias("quantity_sold")), "purchase_id"
    )


def with_prices(lines: DataFrame, prices: DataFrame) -> DataFrame:
    return lines.join(prices.select("item_id", "size_id", "value"), ["item_id", "size_id"])


def fact_sales(
    purchases: DataFrame,
    status: DataFrame,
    lines: DataFrame,
    prices: DataFrame,
    dim_time: DataFrame,
    complete: bool = False,
    keep_year: bool = False,
) -> DataFrame:
    """One row per purchase line that has a status, a price and a date.

    Lines, purchases and status meet on the purchase id, so one exchange of the
    lines serves both joins. Lines meet the purchases directly, exchange against
    exchange: in that shape adaptive execution can cut up a purchase that holds a
    large share of the lines. Prices follow on their own key, where the same holds
    for a hot item; below the broadcast threshold they move no line at all.
    """
    dated = dated_purchases(purchases, dim_time, complete)
    priced = with_prices(with_status(with_lines(dated, lines), status), prices)
    valued = priced.withColumn("line_value", line_value(F.col("value"), F.col("quantity_sold")))
    shaped = [F.col(c.name).cast(c.type).alias(c.name) for c in TARGETS["fact_sales"].columns]
    return valued.select(*shaped, *(["year"] if keep_year else []))


def judged_sales(
    purchases: DataFrame, status: DataFrame, lines: DataFrame, prices: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """The lines of the purchases as facts with their year; ``_status`` and ``_price`` are null where a line waits for one.

    Rows with both are ``fact_sales``, the others its dropped lines. A date that dim_time lacks fails the job.
    """
    stated = status.select("purchase_id", F.col("status").alias("purchase_status"), F.lit(True).alias("_status"))
    priced = prices.select("item_id", "size_id", "value", F.lit(True).alias("_price"))
    judged = (
        with_lines(dated_purchases(purchases, dim_time, True), lines)
        .join(stated, "purchase_id", "left")
        .join(priced, ["item_id", "size_id"], "left")
        .withColumn("line_value", line_value(F.col("value"), F.col("quantity_sold")))
    )
    shaped = [F.col(c.name).cast(c.type).alias(c.name) for c in TARGETS["fact_sales"].columns]
    return judged.select(*shaped, "year", "_status", "_price")


def dropped_lines(
    purchases: DataFrame, status: DataFrame, lines: DataFrame, prices: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """How many lines the inner joins of fact_sales leave out, by reason."""
    dated = purchases.join(
        F.broadcast(dim_time.select(F.col("date").alias("order_date"), F.lit(True).alias("_date"))), "order_date", "left"
    ).select(F.col("id").alias("purchase_id"), "_date", F.lit(True).alias("_purchase"))
    stated = status.select("purchase_id", F.lit(True).alias("_status"))
    priced = prices.select("item_id", "size_id", F.lit(True).alias("_price"))
    judged = (
        lines.join(dated, "purchase_id", "left")
        .join(stated, "purchase_id", "left")
        .join(priced, ["item_id", "size_id"], "left")
    )
    count = {
        "no_purchase": F.col("_purchase").isNull(),
        "no_date": F.col("_purchase").isNotNull() & F.col("_date").isNull(),
        "no_status": F.col("_status").isNull(),
        "no_price": F.col("_price").isNull(),
    }
    return judged.agg(*(F.count_if(bad).alias(name) for name, bad in count.items()))


def date_id_of(dim_time: DataFrame, date: dt.date) -> int:
    """The date_id of one day; an error when dim_time lacks it."""
    found = dim_time.where(F.col("date") == F.lit(date)).select("date_id").first()
    if found is None:
        raise LookupError(f"{date} is not in dim_time")
    return found["date_id"]


def fact_inventory(inventory: DataFrame, date_id: int) -> DataFrame:
    """Stock of every (item, size, store) at one date.

    Stock rows without catalog pair stay, so no join with items_sizes is needed.
    """
    stock = inventory.withColumnRenamed("quantity", "quantity_in_stock").withColumn("date_id", F.lit(date_id))
    return stock.select(*(F.col(c.name).cast(c.type).alias(c.name) for c in TARGETS["fact_inventory"].columns))


def stock_with_catalog(items_sizes: DataFrame, inventory: DataFrame) -> DataFrame:
    """Every stock row, flagged ``in_catalog`` when its (item, size) pair is a catalog pair."""
    pairs = items_sizes.select("item_id", "size_id", F.lit(True).alias("in_catalog"))
    return pairs.join(inventory.drop("created_at"), ["item_id", "size_id"], "right").select(
        "item_id", "size_id", "store_id", "quantity", F.coalesce("in_catalog", F.lit(False)).alias("in_catalog")
    )
