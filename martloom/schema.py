"""Declared schemas of the 17 source and 7 target tables, with their rules as data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
DATE, STAMP, MONEY = T.DateType(), T.TimestampNTZType(), T.DecimalType(10, 2)
FLOAT, FLAG = T.DoubleType(), T.BooleanType()

# --- fixed values: results depend on them -----------------------------------
STATE_REGIONS = {
    "AC": "Norte",
    "AL": "Nordeste",
    "AP": "Norte",
    "AM": "Norte",
    "BA": "Nordeste",
    "CE": "Nordeste",
    "DF": "Centro-Oeste",
    "ES": "Sudeste",
    "GO": "Centro-Oeste",
    "MA": "Nordeste",
    "MT": "Centro-Oeste",
    "MS": "Centro-Oeste",
    "MG": "Sudeste",
    "PA": "Norte",
    "PB": "Nordeste",
    "PR": "Sul",
    "PE": "Nordeste",
    "PI": "Nordeste",
    "RJ": "Sudeste",
    "RN": "Nordeste",
    "RS": "Sul",
    "RO": "Norte",
    "RR": "Norte",
    "SC": "Sul",
    "SP": "Sudeste",
    "SE": "Nordeste",
    "TO": "Norte",
}
REGIONS = ("Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul")
STATUSES = ("Pending", "Sent", "Delivered", "Canceled")
PHONE_TYPES = ("Residential", "Mobile", "Commercial")
NAME_PARTICLES = ("da", "de", "dos", "das")
ZIP_PATTERN = r"^[0-9]{5}(-?[0-9]{3})?\z"
# area codes; a comma is none (decision D10)
AREA_CODES = (
    "11 12 13 14 15 16 17 18 19 21 22 23 24 27 28 31 32 33 34 35 36 37 38 41 42 43 44 45 46 47 48 49 51 53 54 55 "
    "61 62 63 64 65 66 67 68 69 71 73 74 75 77 79 81 82 83 84 85 86 87 88 89 91 92 93 94 95 96 97 98 99"
)
PHONE_PATTERN = rf"^\(?({AREA_CODES.replace(' ', '|')})\)?[-\s]?\d{{4,5}}[-\s]?\d{{4}}\z"
LOCAL_ZONE = "America/Sao_Paulo"
# Tables an incremental load slices by created_at; the other four have no part in a target.
SLICED_SOURCES = (
    "customers",
    "items",
    "sizes",
    "stores",
    "categories",
    "purchases",
    "purchases_status",
    "purchases_items",
    "prices",
    "items_sizes",
    "inventory",
    "stores_addresses",
    "addresses",
)
# Columns an upsert may change on a row that is already there.
UPSERT_COLUMNS = {
    "dim_customers": ("full_name", "email", "created_at"),
    "dim_items": ("name", "category_name"),
    "dim_sizes": ("size",),
    "dim_stores": ("name", "city", "state", "zip_code", "region"),
}
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    nullable: bool = False
    length: int | None = None


@dataclass(frozen=True)
class Domain:
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Minimum:
    column: str
    bound: int
    strict: bool = False


@dataclass(frozen=True)
class Pattern:
    column: str
    regex: str


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Table:
    name: str
    columns: tuple[Column, ...]
    key: tuple[str, ...]
    references: tuple[Reference, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    checks: tuple[Domain | Minimum | Pattern, ...] = ()

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.type, c.nullable) for c in self.columns])


def _text(name: str, length: int, nullable: bool = False) -> Column:
    return Column(name, TEXT, nullable, length)


def _to(parent: str, column: str, parent_column: str = "id") -> Reference:
    return Reference((column,), parent, (parent_column,))


_ID = Column("id", LONG)
_CREATED = Column("created_at", STAMP)
_ITEM, _SIZE, _STORE = Column("item_id", LONG), Column("size_id", LONG), Column("store_id", LONG)
_STATE_DOMAIN = Domain("state", tuple(STATE_REGIONS))
_ZIP = Pattern("zip_code", ZIP_PATTERN)
_ITEM_SIZE_REFS = (_to("items", "item_id"), _to("sizes", "size_id"))

SOURCES = {
    t.name: t
    for t in (
        Table("categories", (_ID, _text("name", 50), _CREATED), ("id",)),
        Table(
            "items",
            (_ID, _text("name", 50), Column("category_id", LONG), _CREATED),
            ("id",),
            references=(_to("categories", "category_id"),),
        ),
        Table("sizes", (_ID, _text("size", 10), _CREATED), ("id",)),
        Table("items_sizes", (_ITEM, _SIZE, _CREATED), ("item_id", "size_id"), references=_ITEM_SIZE_REFS),
        Table(
            "prices",
            (_ITEM, _SIZE, Column("value", MONEY), _CREATED),
            ("item_id", "size_id"),
            references=_ITEM_SIZE_REFS,
            checks=(Minimum("value", 0, strict=True),),
        ),
        Table("stores", (_ID, _text("name", 50), _text("email", 50), _CREATED), ("id",)),
        Table(
            "addresses",
            (
                _ID,
                _text("street", 100),
                _text("number", 10),
                _text("complement", 50, True),
                _text("neighborhood", 50, True),
                _text("city", 50, True),
                _text("state", 2),
                _text("zip_code", 10),
                _text("country", 50, True),
                _CREATED,
            ),
            ("id",),
            checks=(_STATE_DOMAIN, _ZIP),
        ),
        Table(
            "stores_addresses",
            (_STORE, Column("address_id", LONG), _CREATED),
            ("store_id", "address_id"),
            references=(_to("stores", "store_id"), _to("addresses", "address_id")),
        ),
        Table(
            "customers",
            (Column("customer_id", LONG), _text("full_name", 50), _text("email", 50), _CREATED),
            ("customer_id",),
        ),
        Table(
            "customers_addresses",
            (Column("customer_id", LONG), Column("address_id", LONG), _CREATED),
            ("customer_id", "address_id"),
            references=(_to("customers", "customer_id", "customer_id"), _to("addresses", "address_id")),
        ),
        Table(
            "phones",
            (_ID, _text("phone_type", 20, True), _text("number", 20)),
            ("id",),
            checks=(Domain("phone_type", PHONE_TYPES), Pattern("number", PHONE_PATTERN)),
        ),
        Table(
            "phones_customers",
            (Column("phone_id", LONG), Column("customer_id", LONG)),
            ("phone_id", "customer_id"),
            references=(_to("phones", "phone_id"), _to("customers", "customer_id", "customer_id")),
        ),
        Table(
            "phones_stores",
            (Column("phone_id", LONG), _STORE),
            ("phone_id", "store_id"),
            references=(_to("phones", "phone_id"), _to("stores", "store_id")),
        ),
        Table(
            "purchases",
            (_ID, Column("customer_id", LONG, True), _STORE, Column("order_date", DATE), _CREATED),
            ("id",),
            references=(_to("customers", "customer_id", "customer_id"), _to("stores", "store_id")),
        ),
        Table(
            "purchases_items",
            (Column("purchase_id", LONG), _ITEM, _SIZE, Column("quantity", INT), _CREATED),
            ("purchase_id", "item_id", "size_id"),
            references=(
                _to("purchases", "purchase_id"),
                *_ITEM_SIZE_REFS,
                Reference(("item_id", "size_id"), "items_sizes", ("item_id", "size_id")),
            ),
            checks=(Minimum("quantity", 0, strict=True),),
        ),
        Table(
            "purchases_status",
            (Column("purchase_id", LONG), _text("status", 20), _CREATED),
            ("purchase_id",),
            references=(_to("purchases", "purchase_id"),),
            checks=(Domain("status", STATUSES),),
        ),
        Table(
            "inventory",
            (_ITEM, _SIZE, _STORE, Column("quantity", LONG), _CREATED),
            ("item_id", "size_id", "store_id"),
            references=(*_ITEM_SIZE_REFS, _to("stores", "store_id")),
            checks=(Minimum("quantity", 0),),
        ),
    )
}

# In load order: dimensions before the facts that refer to them.
TARGETS = {
    t.name: t
    for t in (
        Table(
            "dim_time",
            (
                Column("date_id", INT),
                Column("date", DATE),
                Column("day", INT),
                Column("month", INT),
                Column("quarter", INT),
                Column("year", INT),
                Column("is_weekend", FLAG),
            ),
            ("date_id",),
            unique=(("date",),),
        ),
        Table(
            "dim_customers",
            (Column("customer_id", LONG), _text("full_name", 50), _text("email", 50), _CREATED),
            ("customer_id",),
        ),
        Table(
            "dim_items",
            (_ITEM, _text("name", 50, True), _text("category_name", 50)),
            ("item_id",),
        ),
        Table("dim_sizes", (_SIZE, _text("size", 10)), ("size_id",)),
        Table(
            "dim_stores",
            (
                _STORE,
                _text("name", 50),
                _text("city", 50, True),
                _text("state", 2),
                _text("region", 20),
                _text("zip_code", 10),
            ),
            ("store_id",),
            checks=(_STATE_DOMAIN, _ZIP, Domain("region", REGIONS)),
        ),
        Table(
            "fact_sales",
            (
                Column("purchase_id", LONG),
                _ITEM,
                _SIZE,
                Column("customer_id", LONG, True),
                _STORE,
                Column("date_id", INT),
                _text("purchase_status", 20),
                Column("line_value", FLOAT),
                Column("quantity_sold", INT),
            ),
            ("purchase_id", "item_id", "size_id"),
            references=(
                _to("dim_items", "item_id", "item_id"),
                _to("dim_sizes", "size_id", "size_id"),
                _to("dim_customers", "customer_id", "customer_id"),
                _to("dim_stores", "store_id", "store_id"),
                _to("dim_time", "date_id", "date_id"),
            ),
            checks=(
                Minimum("line_value", 0),
                Minimum("quantity_sold", 0),
                Domain("purchase_status", STATUSES),
            ),
        ),
        Table(
            "fact_inventory",
            (_ITEM, _SIZE, _STORE, Column("date_id", INT), Column("quantity_in_stock", LONG)),
            ("item_id", "size_id", "store_id", "date_id"),
            references=(
                _to("dim_items", "item_id", "item_id"),
                _to("dim_sizes", "size_id", "size_id"),
                _to("dim_stores", "store_id", "store_id"),
                _to("dim_time", "date_id", "date_id"),
            ),
            checks=(Minimum("quantity_in_stock", 0),),
        ),
    )
}
