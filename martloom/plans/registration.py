"""Registration of nested orders, customers and stores into the source tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.calendar import zoneless
from martloom.functions.text import customer_email, store_email
from martloom.operators.audit import require_room
from martloom.operators.keys import dense_ids
from martloom.operators.stock import MAX_GROUP, allocate, apply_decrements, orders_without_lines, rejected_lines
from martloom.session import materialize

STOCK_KEYS = ["item_id", "size_id", "store_id"]


def _stamp(created_at: Column | dt.datetime | None) -> Column:
    """The load time of new rows, in UTC: the one given, else now."""
    if created_at is None:
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    return zoneless(created_at)


def basket_lines(orders: DataFrame) -> DataFrame:
    """Lines of nested orders, a pair named twice in one basket summed to one line."""
    lines = orders.select("order_seq", "store_id", F.explode("lines").alias("line"))
    return lines.groupBy("order_seq", "store_id", "line.item_id", "line.size_id").agg(
        F.sum("line.quantity").cast("int").alias("quantity")
    )


def register_orders(
    orders: DataFrame,
    inventory: DataFrame,
    created_at: Column | dt.datetime | None = None,
    last_id: int = 0,
    purchases: DataFrame | None = None,
    limit: int | None = None,
    max_group: int = MAX_GROUP,
) -> dict[str, DataFrame]:
    """Nested orders to purchases, lines and status, against stock, in ``order_seq`` order.

    A line is accepted while its stock lasts; an order is kept when at least one
    line is. Also returned: the refused lines, the orders left empty, and the stock
    afterwards. ``limit`` caps the purchases already stored, as a guard before ingest.
    """
    if limit is not None:
        if purchases is None:
            raise ValueError("limit needs the purchases that are stored")
        require_room(purchases, limit)
    stamp = _stamp(created_at)
    judged = materialize(allocate(basket_lines(orders), inventory, STOCK_KEYS, ["order_seq"], max_group=max_group), "allocated")
    accepted = judged.where("accepted").drop("accepted")
    kept = orders.drop("lines").join(accepted.select("order_seq").distinct(), "order_seq", "left_semi")
    header = materialize(dense_ids(kept, ["order_seq"], "purchase_id", last_id + 1), "purchases")
    lines = accepted.join(header.select("order_seq", "purchase_id"), "order_seq")
    return {
        "purchases": header.select(
            F.col("purchase_id").alias("id"), "customer_id", "store_id", "order_date", stamp.alias("created_at")
        ),
        "purchases_items": lines.select("purchase_id", "item_id", "size_id", "quantity", stamp.alias("created_at")),
        "purchases_status": header.select("purchase_id", "status", stamp.alias("created_at")),
        "rejected_lines": rejected_lines(judged),
        "empty_orders": orders_without_lines(judged, "order_seq"),
        "inventory": apply_decrements(inventory, accepted, STOCK_KEYS),
    }


def _address(owner: Column, stamp: Column) -> list[Column]:
    parts = ("street", "number", "complement", "neighborhood", "city", "state", "zip_code")
    return [
        owner.alias("id"),
        *(F.col(f"address.{p}").alias(p) for p in parts),
        F.coalesce("address.country", F.lit("Brasil")).alias("country"),
        stamp.alias("created_at"),
    ]


def _register(
    people: DataFrame,
    order_by: list[str],
    owner: str,
    id_of: str,
    email,
    name: str,
    stamp: Column,
    last_ids: dict[str, int],
) -> dict[str, DataFrame]:
    # Every entry has one address, so owner and address share one numbering; phones
    # are optional and are numbered among the entries that have one.
    plural = f"{owner}s"
    first = last_ids.get(plural, 0) + 1
    numbered = materialize(dense_ids(people, order_by, id_of, first), plural)
    address_id = F.col(id_of) - first + last_ids.get("addresses", 0) + 1
    phones = materialize(
        dense_ids(
            numbered.where(F.col("phone").isNotNull()).select(id_of, "phone"),
            [id_of],
            "phone_id",
            last_ids.get("phones", 0) + 1,
        ),
        "phones",
    )
    return {
        plural: numbered.select(id_of, name, email(F.col(name)).alias("email"), stamp.alias("created_at")),
        "addresses": numbered.select(*_address(address_id, stamp)),
        f"{plural}_addresses": numbered.select(id_of, address_id.alias("address_id"), stamp.alias("created_at")),
        "phones": phones.select(
            F.col("phone_id").alias("id"),
            F.col("phone.phone_type").alias("phone_type"),
            F.col("phone.number").alias("number"),
        ),
        f"phones_{plural}": phones.select("phone_id", id_of),
    }


def register_customers(
    customers: DataFrame,
    order_by: list[str],
    created_at: Column | dt.datetime | None = None,
    last_ids: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Nested customers (full_name, address struct, optional phone struct) to five linked tables."""
    stamp = _stamp(created_at)
    return _register(
        customers, order_by, "customer", "customer_id", customer_email, "full_name", stamp, last_ids or {}
    )


def register_stores(
    stores: DataFrame,
    order_by: list[str],
    created_at: Column | dt.datetime | None = None,
    last_ids: dict[str, int] | None = None,
) -> dict[str, DataFrame]:
    """Nested stores (name, address struct, optional phone struct) to five linked tables."""
    stamp = _stamp(created_at)
    tables = _register(stores, order_by, "store", "store_id", store_email, "name", stamp, last_ids or {})
    return {**tables, "stores": tables["stores"].withColumnRenamed("store_id", "id")}
