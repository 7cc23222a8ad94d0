"""Queries on scans, projections, joins, dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.operators.audit import audit_counts, created_after, first_n, room_left, sample_rows, union_all
from martloom.operators.keys import dense_ids, pair_by_position
from martloom.operators.merge import difference
from martloom.plans import catalog as cat
from martloom.plans import dims, facts, star
from martloom.plans.registration import basket_lines
from martloom.schema import SLICED_SOURCES, SOURCES, TARGETS
from martloom.session import work_path
from martloom.sources.tables import created_between, extract, read_catalog_csv
from registry.base import FIRST_SNAPSHOT, HIGH, LOW, SNAPSHOT, Inputs, query
from registry.views import HIGH_SQL, LOW_SQL, SNAPSHOT_SQL


def early(t: Inputs) -> DataFrame:
    return created_between(t.purchases, None, LOW)


def delta(t: Inputs) -> DataFrame:
    return created_between(t.purchases, LOW, HIGH)


def days_early(t: Inputs) -> DataFrame:
    return dims.dim_time(early(t), FIRST_SNAPSHOT)


def days_added(t: Inputs) -> DataFrame:
    return dims.dim_time_additions(days_early(t), delta(t), SNAPSHOT)


def days_loaded(t: Inputs) -> DataFrame:
    return days_early(t).unionByName(days_added(t))


def days(t: Inputs) -> DataFrame:
    return dims.dim_time(t.purchases, SNAPSHOT)


def sales(t: Inputs, purchases: DataFrame, dim_time: DataFrame, **options) -> DataFrame:
    return facts.fact_sales(purchases, t.purchases_status, t.purchases_items, t.prices, dim_time, **options)


def targets(t: Inputs) -> dict[str, DataFrame]:
    d = days(t)
    return {
        "dim_time": d,
        "dim_customers": dims.dim_customers(t.customers),
        "dim_items": dims.dim_items(t.items, t.categories),
        "dim_sizes": dims.dim_sizes(t.sizes),
        "dim_stores": dims.dim_stores(t.stores, t.stores_addresses, t.addresses),
        "fact_sales": sales(t, t.purchases, d),
        "fact_inventory": facts.fact_inventory(t.inventory, facts.date_id_of(d, SNAPSHOT)),
    }


# Money is compared in whole cents and times without a zone, as both engines write them alike.
_CENTS = {"line_value"}
_TIMES = {"created_at"}


def rows_of(tables: dict[str, DataFrame], declared=SOURCES) -> DataFrame:
    """Every row of every table with all its declared columns as one text."""

    def text(c: str):
        x = F.round(F.col(c) * 100).cast("bigint") if c in _CENTS else F.col(c).cast("timestamp_ntz") if c in _TIMES else F.col(c)
        return F.coalesce(x.cast("string"), F.lit("null"))

    return union_all(
        [
            df.select(F.lit(n).alias("table_name"), F.concat_ws("|", *(text(c.name) for c in declared[n].columns)).alias("content"))
            for n, df in tables.items()
        ]
    )


def rows_sql(tables: dict[str, str], declared=SOURCES) -> str:
    """The same in DuckDB; ``tables`` gives what stands after FROM."""

    def text(c: str) -> str:
        x = f"CAST(round({c} * 100) AS BIGINT)" if c in _CENTS else f"CAST({c} AS TIMESTAMP)" if c in _TIMES else c
        return f"coalesce(CAST({x} AS VARCHAR), 'null')"

    return "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, concat_ws('|', {', '.join(text(c.name) for c in declared[n].columns)}) AS content FROM {src}"
        for n, src in tables.items()
    )


def counts_sql(tables: dict[str, str]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {src}" for n, src in tables.items())


# --- scans --------------------------------------------------------------------

@query("src_full_extract", rows_sql({n: n for n in SOURCES}))
def src_full_extract(t: Inputs) -> DataFrame:
    return rows_of(extract(t.bundle(*SOURCES)))


_SLICE_LOW, _SLICE_HIGH = "TIMESTAMP '2000-06-30'", "TIMESTAMP '2025-01-15'"


def _slice(t: Inputs) -> dict[str, DataFrame]:
    return extract(t.bundle(*SLICED_SOURCES), dt.datetime(2000, 6, 30), dt.datetime(2025, 1, 15))


_SLICE_WHERE = f"created_at > {_SLICE_LOW} AND created_at <= {_SLICE_HIGH}"


@query("src_incremental_extract", rows_sql({n: f"{n} WHERE {_SLICE_WHERE}" for n in SLICED_SOURCES}))
def src_incremental_extract(t: Inputs) -> DataFrame:
    return rows_of(_slice(t))


@query(
    "src_delta_counts",
    counts_sql({n: f"{n} WHERE {_SLICE_WHERE}" for n in SLICED_SOURCES}),
)
def src_delta_counts(t: Inputs) -> DataFrame:
    return audit_counts(_slice(t))


@query(
    "src_catalog_csv",
    "SELECT nome_item, categoria, tamanhos_validos, row_number() OVER (ORDER BY position) - 1 AS position FROM catalog",
)
def src_catalog_csv(t: Inputs) -> DataFrame:
    path = work_path(t.spark, "catalog-csv")
    ordered = t.catalog.repartitionByRange("position").sortWithinPartitions("position").drop("position")
    ordered.write.option("header", True).csv(path)
    return read_catalog_csv(t.spark, path)


# --- projections and filters --------------------------------------------------


@query("prj_rename_sizes", "SELECT id AS size_id, size FROM sizes")
def prj_rename_sizes(t: Inputs) -> DataFrame:
    return t.sizes.withColumnRenamed("id", "size_id").drop("created_at")


@query(
    "prj_line_value",
    """SELECT purchase_id, i.item_id, i.size_id, CAST(value AS DOUBLE) * quantity AS line_value
FROM purchases_items i JOIN prices p ON p.item_id = i.item_id AND p.size_id = i.size_id""",
)
def prj_line_value(t: Inputs) -> DataFrame:
    return t.purchases_items.join(t.prices, ["item_id", "size_id"]).select(
        "purchase_id",
        "item_id",
        "size_id",
        facts.line_value(F.col("value"), F.col("quantity")).alias("line_value"),
    )


@query("flt_date_lookup", f"SELECT date_id, date FROM dim_time WHERE date = {SNAPSHOT_SQL}")
def flt_date_lookup(t: Inputs) -> DataFrame:
    d = days(t)
    return d.where(F.col("date_id") == facts.date_id_of(d, SNAPSHOT)).select("date_id", "date")


@query(
    "flt_items_in_catalog",
    """SELECT nome_item, categoria, position FROM catalog
WHERE categoria IN ('ECONOMY', 'SMALL') AND nome_item IN (SELECT p_name || ' ' || p_partkey FROM part WHERE p_partkey IN (SELECT item_id FROM prices))""",
)
def flt_items_in_catalog(t: Inputs) -> DataFrame:
    priced = t.items.join(t.prices, F.col("id") == F.col("item_id"), "left_semi").select(
        F.concat_ws(" ", "name", F.col("id").cast("string")).alias("nome_item")
    )
    return (
        t.catalog.where(F.col("categoria").isin("ECONOMY", "SMALL"))
        .join(priced, "nome_item", "left_semi")
        .select("nome_item", "categoria", "position")
    )


# --- joins --------------------------------------------------------------------

_DATED = "purchase_id", "customer_id", "store_id", "date_id"


@query(
    "jn_sales_date",
    """SELECT id AS purchase_id, customer_id, store_id, date_id
FROM purchases JOIN dim_time_early ON date = order_date""",
)
def jn_sales_date(t: Inputs) -> DataFrame:
    return facts.dated_purchases(t.purchases, days_early(t)).select(*_DATED)


@query(
    "jn_sales_date_checked",
    """SELECT id AS purchase_id, customer_id, store_id, date_id
FROM delta LEFT JOIN dim_time_loaded ON date = order_date""",
)
def jn_sales_date_checked(t: Inputs) -> DataFrame:
    return facts.dated_purchases(delta(t), days_loaded(t), complete=True).select(*_DATED)


@query(
    "jn_sales_status",
    """SELECT id AS purchase_id, store_id, date_id, status AS purchase_status
FROM purchases JOIN dim_time ON date = order_date JOIN purchases_status s ON s.purchase_id = id""",
)
def jn_sales_status(t: Inputs) -> DataFrame:
    dated = facts.dated_purchases(t.purchases, days(t))
    return facts.with_status(dated, t.purchases_status).select("purchase_id", "store_id", "date_id", "purchase_status")


@query(
    "jn_sales_items",
    """SELECT id AS purchase_id, store_id, status AS purchase_status, item_id, size_id, quantity AS quantity_sold
FROM purchases JOIN purchases_status s ON s.purchase_id = id JOIN purchases_items i ON i.purchase_id = id""",
)
def jn_sales_items(t: Inputs) -> DataFrame:
    header = facts.with_status(t.purchases.withColumnRenamed("id", "purchase_id"), t.purchases_status)
    return facts.with_lines(header, t.purchases_items).drop("customer_id", "order_date", "created_at")


@query(
    "jn_sales_prices",
    """SELECT purchase_id, i.item_id, i.size_id, quantity, value
FROM purchases_items i JOIN prices p ON p.item_id = i.item_id AND p.size_id = i.size_id""",
)
def jn_sales_prices(t: Inputs) -> DataFrame:
    return facts.with_prices(t.purchases_items, t.prices).select(
        "purchase_id", "item_id", "size_id", "quantity", "value"
    )


@query(
    "jn_inventory_right",
    """SELECT v.item_id, v.size_id, v.store_id, v.quantity, s.item_id IS NOT NULL AS in_catalog
FROM items_sizes s RIGHT JOIN inventory v ON v.item_id = s.item_id AND v.size_id = s.size_id""",
)
def jn_inventory_right(t: Inputs) -> DataFrame:
    return facts.stock_with_catalog(t.items_sizes, t.inventory)


@query(
    "jn_positional_pair",
    """SELECT s.rn AS position, s.id AS store_id, a.id AS address_id
FROM (SELECT id, row_number() OVER (ORDER BY id) AS rn FROM stores) s
JOIN (SELECT id, row_number() OVER (ORDER BY id DESC) AS rn FROM addresses) a ON a.rn = s.rn""",
)
def jn_positional_pair(t: Inputs) -> DataFrame:
    backwards = t.addresses.select(F.col("id").alias("address_id"), (-F.col("id")).alias("_rank"))
    return pair_by_position(t.stores.select(F.col("id").alias("store_id")), ["store_id"], backwards, ["_rank"]).drop(
        "_rank"
    )


# --- aggregates ---------------------------------------------------------------


@query("agg_distinct_dates", "SELECT DISTINCT order_date AS date FROM purchases")
def agg_distinct_dates(t: Inputs) -> DataFrame:
    return dims.order_dates(t.purchases)


_MAX_KEYS = {"dim_time": "date_id", "dim_customers": "customer_id", "dim_items": "item_id"}
_MAX_KEYS |= {"dim_sizes": "size_id", "dim_stores": "store_id"}


@query(
    "agg_max_keys",
    "\nUNION ALL ".join(
        f"SELECT '{n}' AS table_name, CAST(coalesce(max({k}), 0) AS BIGINT) AS max_key FROM {n}"
        for n, k in _MAX_KEYS.items()
    )
    + "\nUNION ALL SELECT 'empty', coalesce(max(size_id), 0) FROM dim_sizes WHERE size_id < 0",
)
def agg_max_keys(t: Inputs) -> DataFrame:
    built = targets(t)
    frames = {n: built[n].select(F.col(k).cast("bigint").alias("k")) for n, k in _MAX_KEYS.items()}
    frames["empty"] = frames["dim_sizes"].where("k < 0")
    return union_all(
        [
            df.agg(F.lit(n).alias("table_name"), F.coalesce(F.max("k"), F.lit(0)).cast("bigint").alias("max_key"))
            for n, df in frames.items()
        ]
    )


@query(
    "agg_counts",
    """SELECT (SELECT count(*) FROM purchases) AS n_purchases, (SELECT count(*) FROM customers) AS n_customers,
(SELECT count(*) FROM purchases) >= 500 AS limit_reached""",
)
def agg_counts(t: Inputs) -> DataFrame:
    counted = audit_counts({"purchases": t.purchases, "customers": t.customers})
    n = {name: F.sum(F.when(F.col("table_name") == name, F.col("n_rows"))) for name in ("purchases", "customers")}
    return counted.agg(
        n["purchases"].alias("n_purchases"),
        n["customers"].alias("n_customers"),
        (room_left(n["purchases"], 500) <= 0).alias("limit_reached"),
    )


@query(
    "agg_basket_merge",
    """SELECT l_orderkey AS order_seq, l_orderkey % 10 AS store_id, l_partkey AS item_id, size_id, CAST(sum(quantity) AS INTEGER) AS quantity
FROM demand GROUP BY ALL""",
)
def agg_basket_merge(t: Inputs) -> DataFrame:
    line = F.struct(F.col("l_partkey").alias("item_id"), "size_id", "quantity")
    return basket_lines(
        t.demand.select(
            F.col("l_orderkey").alias("order_seq"), (F.col("l_orderkey") % 10).alias("store_id"), F.array(line).alias("lines")
        )
    )


@query("agg_audit_counts", counts_sql({n: n for n in TARGETS}))
def agg_audit_counts(t: Inputs) -> DataFrame:
    return audit_counts(targets(t))


@query(
    "agg_dropped_lines",
    """SELECT count(*) FILTER (p.id IS NULL) AS no_purchase, count(*) FILTER (p.id IS NOT NULL AND d.date IS NULL) AS no_date,
       count(*) FILTER (s.purchase_id IS NULL) AS no_status, count(*) FILTER (r.item_id IS NULL) AS no_price
FROM purchases_items i LEFT JOIN purchases p ON p.id = i.purchase_id LEFT JOIN dim_time_early d ON d.date = p.order_date
LEFT JOIN purchases_status s ON s.purchase_id = i.purchase_id
LEFT JOIN prices r ON r.item_id = i.item_id AND r.size_id = i.size_id""",
)
def agg_dropped_lines(t: Inputs) -> DataFrame:
    return facts.dropped_lines(t.purchases, t.purchases_status, t.purchases_items, t.prices, days_early(t))


# --- numbering, top, set operations --------------------------------------------


@query(
    "key_dense_ids",
    "SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders",
)
def key_dense_ids(t: Inputs) -> DataFrame:
    return dense_ids(t.raw("orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


def _draw_sql(table: str, keys: list[str]) -> str:
    text = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return f"""SELECT * FROM (SELECT '{table}' AS table_name, {text} AS key FROM {table}
ORDER BY md5({text} || '|2025'), {', '.join(keys)} LIMIT 10)"""


_DRAWN = {"customers": ["customer_id"], "stores": ["id"], "items_sizes": ["item_id", "size_id"]}


@query("top_random_rows", "\nUNION ALL ".join(_draw_sql(n, k) for n, k in _DRAWN.items()))
def top_random_rows(t: Inputs) -> DataFrame:
    return union_all(
        [
            sample_rows(df, _DRAWN[n], 10, "2025").select(
                F.lit(n).alias("table_name"), F.concat_ws("|", *(F.col(k).cast("string") for k in _DRAWN[n])).alias("key")
            )
            for n, df in t.bundle(*_DRAWN).items()
        ]
    )


@query("top_first_n", "SELECT nome_item, categoria, tamanhos_validos, position FROM catalog ORDER BY position LIMIT 40")
def top_first_n(t: Inputs) -> DataFrame:
    return first_n(t.catalog, "position", 40)


@query(
    "top_recent_purchases",
    f"SELECT id AS purchase_id, created_at FROM purchases WHERE created_at > {LOW_SQL} ORDER BY created_at DESC",
)
def top_recent_purchases(t: Inputs) -> DataFrame:
    return created_after(t.purchases, LOW).select(F.col("id").alias("purchase_id"), "created_at")


@query("set_union_snapshot_date", f"SELECT order_date AS date FROM purchases UNION SELECT {SNAPSHOT_SQL}")
def set_union_snapshot_date(t: Inputs) -> DataFrame:
    return dims.order_dates(t.purchases, SNAPSHOT)


@query("set_new_dates", "SELECT order_date AS date FROM delta EXCEPT SELECT date FROM dim_time_early")
def set_new_dates(t: Inputs) -> DataFrame:
    dates = delta(t).select(F.col("order_date").alias("date"))
    return difference(dates, days_early(t), ["date"])


# --- catalog ------------------------------------------------------------------

_CATEGORY_IDS = """
kinds AS (SELECT categoria AS name, row_number() OVER (ORDER BY min(position)) AS id FROM catalog GROUP BY 1)"""
_SIZE_IDS = """
exploded AS (SELECT nome_item, position, unnest(string_split(tamanhos_validos, ';')) AS size FROM catalog),
lengths AS (SELECT size, row_number() OVER (ORDER BY size) AS id FROM (SELECT DISTINCT size FROM exploded))"""
_ITEM_IDS = """
firsts AS (SELECT * FROM catalog QUALIFY row_number() OVER (PARTITION BY nome_item ORDER BY position) = 1),
goods AS (SELECT row_number() OVER (ORDER BY position) AS id, nome_item AS name, k.id AS category_id
          FROM firsts JOIN kinds k ON k.name = categoria)"""


@query("cat_categories", f"WITH {_CATEGORY_IDS} SELECT id, name FROM kinds")
def cat_categories(t: Inputs) -> DataFrame:
    return cat.categories(t.catalog)


@query("cat_sizes", f"WITH {_SIZE_IDS} SELECT id, size FROM lengths")
def cat_sizes(t: Inputs) -> DataFrame:
    return cat.sizes(t.catalog)


@query("cat_items", f"WITH {_CATEGORY_IDS},{_ITEM_IDS} SELECT id, name, category_id FROM goods")
def cat_items(t: Inputs) -> DataFrame:
    return cat.items(t.catalog, cat.categories(t.catalog))


@query(
    "cat_items_sizes",
    f"""WITH {_CATEGORY_IDS},{_SIZE_IDS},{_ITEM_IDS}
SELECT DISTINCT g.id AS item_id, l.id AS size_id FROM exploded e JOIN goods g ON g.name = e.nome_item JOIN lengths l ON l.size = e.size""",
)
def cat_items_sizes(t: Inputs) -> DataFrame:
    return cat.normalise(t.catalog)["items_sizes"]


# --- dimensions and facts -----------------------------------------------------


@query("dim_customers", "SELECT * FROM dim_customers")
def dim_customers(t: Inputs) -> DataFrame:
    return dims.dim_customers(t.customers)


@query("dim_items", "SELECT * FROM dim_items")
def dim_items(t: Inputs) -> DataFrame:
    return dims.dim_items(t.items, t.categories)


@query("dim_sizes", "SELECT * FROM dim_sizes")
def dim_sizes(t: Inputs) -> DataFrame:
    return dims.dim_sizes(t.sizes)


@query("dim_stores", "SELECT * FROM dim_stores")
def dim_stores(t: Inputs) -> DataFrame:
    return dims.dim_stores(t.stores, t.stores_addresses, t.addresses)


@query("dim_time", "SELECT * FROM dim_time")
def dim_time(t: Inputs) -> DataFrame:
    return days(t)


@query("dim_time_incremental", "SELECT * FROM dim_time_added")
def dim_time_incremental(t: Inputs) -> DataFrame:
    return days_added(t)


@query("fct_sales", "SELECT * FROM fact_sales")
def fct_sales(t: Inputs) -> DataFrame:
    return sales(t, t.purchases, days(t))


@query("fct_sales_incremental", "SELECT * FROM sales_delta")
def fct_sales_incremental(t: Inputs) -> DataFrame:
    return sales(t, delta(t), days_loaded(t), complete=True)


@query("fct_inventory", "SELECT * FROM fact_inventory")
def fct_inventory(t: Inputs) -> DataFrame:
    return facts.fact_inventory(t.inventory, facts.date_id_of(days(t), SNAPSHOT))


@query(
    "fct_inventory_incremental",
    f"""SELECT item_id, size_id, store_id, (SELECT date_id FROM dim_time_added WHERE date = {SNAPSHOT_SQL}) AS date_id,
       quantity AS quantity_in_stock FROM inventory WHERE created_at > {_SLICE_HIGH} AND created_at <= {HIGH_SQL}""",
)
def fct_inventory_incremental(t: Inputs) -> DataFrame:
    return facts.fact_inventory(
        created_between(t.inventory, dt.datetime(2025, 1, 15), HIGH), facts.date_id_of(days_loaded(t), SNAPSHOT)
    )


@query(
    "star_sales_by_region_quarter",
    """SELECT s.region, d.year, d.quarter, i.category_name, CAST(sum(CAST(f.line_value AS DECIMAL(18,2))) AS DOUBLE) AS sales_value,
       CAST(sum(f.quantity_sold) AS BIGINT) AS units, count(*) AS n_lines
FROM fact_sales f JOIN dim_time d ON d.date_id = f.date_id JOIN dim_stores s ON s.store_id = f.store_id
JOIN dim_items i ON i.item_id = f.item_id GROUP BY 1, 2, 3, 4""",
)
def star_sales_by_region_quarter(t: Inputs) -> DataFrame:
    d = days(t)
    return star.sales_by_region_quarter(
        sales(t, t.purchases, d),
        dims.dim_stores(t.stores, t.stores_addresses, t.addresses),
        dims.dim_items(t.items, t.categories),
        d,
    )
