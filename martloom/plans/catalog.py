"""Catalog rows (name, category, sizes) normalised to categories, sizes, items and items_sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import split_list
from martloom.operators.keys import dense_ids
from martloom.operators.merge import first_per_key


def categories(catalog: DataFrame) -> DataFrame:
    """Distinct categories numbered by first appearance."""
    seen = catalog.groupBy(F.col("categoria").alias("name")).agg(F.min("position").alias("position"))
    return dense_ids(seen, ["position", "name"]).select("id", "name")


def exploded_sizes(catalog: DataFrame) -> DataFrame:
    return catalog.select(
        "nome_item", "position", F.posexplode(split_list(F.col("tamanhos_validos"))).alias("nth", "size")
    )


def sizes(catalog: DataFrame) -> DataFrame:
    """Distinct sizes numbered in code-point order."""
    return dense_ids(exploded_sizes(catalog).select("size").distinct(), ["size"]).select("id", "size")


def items(catalog: DataFrame, category_ids: DataFrame) -> DataFrame:
    """Distinct names numbered by first appearance; the first category named for an item wins."""
    firsts = first_per_key(catalog.select("nome_item", "categoria", "position"), ["nome_item"], ["position"])
    linked = firsts.join(
        category_ids.select(F.col("name").alias("categoria"), F.col("id").alias("category_id")), "categoria"
    )
    return dense_ids(linked, ["position", "nome_item"]).select("id", F.col("nome_item").alias("name"), "category_id")


def items_sizes(catalog: DataFrame, item_ids: DataFrame, size_ids: DataFrame) -> DataFrame:
    """(item_id, size_id) pairs of the items given."""
    return (
        exploded_sizes(catalog)
        .join(item_ids.select(F.col("id").alias("item_id"), F.col("name").alias("nome_item")), "nome_item")
        .join(size_ids.select(F.col("id").alias("size_id"), "size"), "size")
        .select("item_id", "size_id")
        .distinct()
    )


def normalise(catalog: DataFrame) -> dict[str, DataFrame]:
    kinds, lengths = categories(catalog), sizes(catalog)
    goods = items(catalog, kinds)
    return {
        "categories": kinds,
        "sizes": lengths,
        "items": goods,
        "items_sizes": items_sizes(catalog, goods, lengths),
    }
