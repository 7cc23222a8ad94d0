"""DuckDB definitions of the adapter views and of the targets built from them.

Later views may use earlier ones. FIXTURES.md gives the rules in words.
"""

from __future__ import annotations

from martloom.schema import NAME_PARTICLES, STATE_REGIONS

LOW_SQL = "TIMESTAMP '2001-01-01'"
HIGH_SQL = "TIMESTAMP '2025-06-30'"
FIRST_SNAPSHOT_SQL = "DATE '2001-01-01'"
SNAPSHOT_SQL = "DATE '2025-06-30'"
_START = "TIMESTAMP '2025-01-01'"
_UF = "[" + ", ".join(f"'{s}'" for s in STATE_REGIONS) + "]"
_REGIONS = "MAP {" + ", ".join(f"'{s}': '{r}'" for s, r in STATE_REGIONS.items()) + "}"


def plus_days(days: str) -> str:
    return f"{_START} + to_days(CAST({days} AS INTEGER))"


def region_sql(state: str) -> str:
    return f"({_REGIONS})[{state}]"


def normalize_sql(e: str) -> str:
    return f"regexp_replace(lower({e}), '[^a-z]', '', 'g')"


def parts_sql(e: str) -> str:
    """Words of a name without particles."""
    blanks = r"'[\s\v\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'"
    dropped = ", ".join(f"'{p}'" for p in ("", *NAME_PARTICLES))
    return f"list_filter(string_split(regexp_replace({e}, {blanks}, ' ', 'g'), ' '), lambda w: lower(w) NOT IN ({dropped}))"


def customer_email_sql(parts: str) -> str:
    """E-mail from a column that holds parts_sql."""
    return (
        f"CASE WHEN len({parts}) = 1 THEN {normalize_sql(parts + '[1]')} || '@example.com' "
        f"WHEN len({parts}) > 1 THEN {normalize_sql(parts + '[1]')} || '.' || {normalize_sql(parts + '[-1]')} "
        "|| '@example.com' END"
    )


def store_email_sql(e: str) -> str:
    slug = f"trim(regexp_replace(lower({e}), '[^a-z0-9]+', '_', 'g'), '_')"
    return f"CASE WHEN {slug} <> '' THEN 'contato@' || {slug} || '.com.br' END"


def _calendar(date: str) -> str:
    return (
        f"CAST(day({date}) AS INTEGER) AS day, CAST(month({date}) AS INTEGER) AS month, "
        f"CAST(quarter({date}) AS INTEGER) AS quarter, CAST(year({date}) AS INTEGER) AS year, "
        f"isodow({date}) >= 6 AS is_weekend"
    )


CALENDAR = _calendar("date")


def _sales(purchases: str, days: str) -> str:
    return f"""
SELECT p.id AS purchase_id, i.item_id, i.size_id, p.customer_id, p.store_id, d.date_id,
       s.status AS purchase_status, CAST(r.value AS DOUBLE) * i.quantity AS line_value, i.quantity AS quantity_sold
FROM {purchases} p JOIN {days} d ON d.date = p.order_date JOIN purchases_status s ON s.purchase_id = p.id
JOIN purchases_items i ON i.purchase_id = p.id JOIN prices r ON r.item_id = i.item_id AND r.size_id = i.size_id"""


VIEWS = {
    "categories": f"""
SELECT row_number() OVER (ORDER BY name) AS id, name, {_START} AS created_at FROM (SELECT DISTINCT p_type AS name FROM part)""",
    "items": f"""
SELECT p_partkey AS id, p_name AS name, c.id AS category_id, {plus_days('p_partkey % 30')} AS created_at
FROM part JOIN categories c ON c.name = p_type""",
    "sizes": f"""
SELECT DISTINCT CAST(p_size AS BIGINT) AS id, CAST(p_size AS VARCHAR) AS size, {_START} AS created_at FROM part""",
    "items_sizes": f"""
SELECT p_partkey AS item_id, CAST(p_size AS BIGINT) AS size_id, {plus_days('p_partkey % 30')} AS created_at
FROM part WHERE p_partkey % 50 <> 0""",
    "prices": f"""
SELECT p_partkey AS item_id, CAST(p_size AS BIGINT) AS size_id, CAST(p_retailprice AS DECIMAL(10,2)) AS value,
       {plus_days('p_partkey % 30')} AS created_at FROM part WHERE p_partkey % 97 <> 0""",
    "stores": f"""
SELECT s_suppkey AS id, s_name AS name, {store_email_sql('s_name')} AS email, {plus_days('s_suppkey % 30')} AS created_at FROM supplier""",
    "places": """
SELECT s.*, nth FROM supplier s, (VALUES (0), (1)) v(nth) WHERE nth = 0 OR s_suppkey % 10 = 0""",
    "stores_addresses": f"""
SELECT s_suppkey AS store_id, s_suppkey * 2 + nth AS address_id, {plus_days('s_suppkey % 30 + nth')} AS created_at FROM places""",
    "addresses": f"""
SELECT s_suppkey * 2 + nth AS id, 'Rua ' || s_suppkey AS street, CAST(s_suppkey % 1000 AS VARCHAR) AS number,
       CASE WHEN s_suppkey % 4 <> 0 THEN 'Sala ' || (s_suppkey % 50) END AS complement, 'Centro' AS neighborhood,
       n_name AS city, ({_UF})[(s_nationkey + nth) % 27 + 1] AS state,
       lpad(CAST(s_suppkey % 100000 AS VARCHAR), 5, '0') || CASE WHEN s_suppkey % 13 = 0 THEN '-00' ELSE '-000' END AS zip_code,
       'Brasil' AS country, {plus_days('s_suppkey % 30 + nth')} AS created_at
FROM places LEFT JOIN nation ON n_nationkey = s_nationkey""",
    "customers": f"""
SELECT c_custkey AS customer_id, c_name AS full_name, {customer_email_sql('parts')} AS email,
       {plus_days('c_custkey % 30')} AS created_at FROM (SELECT *, {parts_sql('c_name')} AS parts FROM customer)""",
    "customers_addresses": f"""
SELECT c_custkey AS customer_id, CAST(c_nationkey * 2 AS BIGINT) AS address_id, {plus_days('c_custkey % 30')} AS created_at FROM customer""",
    "phones": """
SELECT c_custkey AS id, (['Residential', 'Mobile', 'Commercial'])[c_custkey % 3 + 1] AS phone_type,
       (c_custkey % 89 + 11) || '-9' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
       || lpad(CAST(c_custkey * 7 % 10000 AS VARCHAR), 4, '0') AS number FROM customer""",
    "phones_customers": "SELECT c_custkey AS phone_id, c_custkey AS customer_id FROM customer",
    "phones_stores": "SELECT s_suppkey AS phone_id, s_suppkey AS store_id FROM supplier",
    "purchases": """
SELECT o_orderkey AS id, CASE WHEN o_custkey % 10 <> 3 THEN o_custkey END AS customer_id, store_id,
       CAST(o_orderdate AS DATE) AS order_date,
       o_orderdate + to_days(CASE WHEN o_orderkey % 20 = 0 THEN 400 ELSE 0 END) AS created_at
FROM orders JOIN (SELECT l_orderkey, min(l_suppkey) AS store_id FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""",
    "purchases_items": """
SELECT l_orderkey AS purchase_id, l_partkey AS item_id, CAST(p_size AS BIGINT) AS size_id,
       CAST(sum(CAST(l_quantity AS INTEGER)) AS INTEGER) AS quantity, max(l_shipdate) AS created_at
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""",
    "purchases_status": """
SELECT o_orderkey AS purchase_id,
       CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'O' THEN 'Sent' WHEN 'F' THEN 'Delivered' END AS status,
       o_orderdate AS created_at FROM orders WHERE o_orderkey % 100 <> 7""",
    "inventory": f"""
SELECT item_id, size_id, store_id, (item_id * 7 + store_id * 13) % 100 AS quantity, {plus_days('(item_id + store_id) % 30')} AS created_at
FROM (SELECT DISTINCT l_partkey AS item_id, CAST(p_size AS BIGINT) AS size_id, l_suppkey AS store_id
      FROM lineitem JOIN part ON p_partkey = l_partkey)""",
    "catalog": """
SELECT p_name || ' ' || p_partkey AS nome_item, p_type AS categoria,
       CASE p_partkey % 3 WHEN 0 THEN 'P;M;G' WHEN 1 THEN 'Unico' ELSE '100ml;200ml' END AS tamanhos_validos,
       p_partkey AS position FROM part""",
    "demand": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER) AS quantity, CAST(p_size AS BIGINT) AS size_id
FROM lineitem JOIN part ON p_partkey = l_partkey""",
    # --- targets of one full load ---
    "dim_time": f"""
SELECT CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS date_id, date, {CALENDAR}
FROM (SELECT order_date AS date FROM purchases UNION SELECT {SNAPSHOT_SQL})""",
    "dim_customers": "SELECT customer_id, full_name, email, created_at FROM customers",
    "dim_items": """
SELECT i.id AS item_id, i.name, c.name AS category_name FROM items i LEFT JOIN categories c ON c.id = i.category_id""",
    "dim_sizes": "SELECT id AS size_id, size FROM sizes",
    "dim_stores": f"""
SELECT s.id AS store_id, s.name, a.city, a.state, {region_sql('a.state')} AS region, a.zip_code
FROM stores s
LEFT JOIN (SELECT store_id, address_id FROM stores_addresses
           QUALIFY row_number() OVER (PARTITION BY store_id ORDER BY created_at DESC, address_id DESC) = 1) b ON b.store_id = s.id
LEFT JOIN addresses a ON a.id = b.address_id""",
    "fact_sales": _sales("purchases", "dim_time"),
    "fact_inventory": f"""
SELECT item_id, size_id, store_id, (SELECT date_id FROM dim_time WHERE date = {SNAPSHOT_SQL}) AS date_id,
       quantity AS quantity_in_stock FROM inventory""",
    # --- a full load up to the mark, then one increment ---
    "early": f"SELECT * FROM purchases WHERE created_at <= {LOW_SQL}",
    "delta": f"SELECT * FROM purchases WHERE created_at > {LOW_SQL} AND created_at <= {HIGH_SQL}",
    "dim_time_early": f"""
SELECT CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS date_id, date, {CALENDAR}
FROM (SELECT order_date AS date FROM early UNION SELECT {FIRST_SNAPSHOT_SQL})""",
    "dim_time_added": f"""
SELECT CAST((SELECT max(date_id) FROM dim_time_early) + row_number() OVER (ORDER BY date) AS INTEGER) AS date_id, date, {CALENDAR}
FROM (SELECT order_date AS date FROM delta UNION SELECT {SNAPSHOT_SQL})
WHERE date NOT IN (SELECT date FROM dim_time_early)""",
    "dim_time_loaded": "SELECT * FROM dim_time_early UNION ALL SELECT * FROM dim_time_added",
    "sales_early": _sales("early", "dim_time_early"),
    "sales_delta": _sales("delta", "dim_time_loaded"),
}
