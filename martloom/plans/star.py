"""Queries the star schema is made for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sales_by_region_quarter(
    fact_sales: DataFrame, dim_stores: DataFrame, dim_items: DataFrame, dim_time: DataFrame
) -> DataFrame:
    """Sales by region, year, quarter and category.

    Facts are summed by (store, item, date) before they meet the dimensions, so a
    hot store or item crosses the network as few rows.
    """
    narrow = fact_sales.groupBy("store_id", "item_id", "date_id").agg(
        F.sum(F.col("line_value").cast("decimal(18,2)")).alias("line_value"),
        F.sum("quantity_sold").alias("quantity_sold"),
        F.count(F.lit(1)).alias("n_lines"),
    )
    return (
        narrow.join(F.broadcast(dim_time.select("date_id", "year", "quarter")), "date_id")
        .join(dim_stores.select("store_id", "region"), "store_id")
        .join(dim_items.select("item_id", "category_name"), "item_id")
        .groupBy("region", "year", "quarter", "category_name")
        .agg(
            F.sum("line_value").cast("double").alias("sales_value"),
            F.sum("quantity_sold").cast("bigint").alias("units"),
            F.sum("n_lines").cast("bigint").alias("n_lines"),
        )
    )
