"""Queries on the declared rules, each over a frame that breaks them in places."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.text import region_of
from martloom.operators import quality as dq
from martloom.operators.audit import union_all
from martloom.operators.stock import apply_decrements
from martloom.plans import dims, facts
from martloom.schema import (
    PHONE_PATTERN,
    REGIONS,
    SOURCES,
    STATE_REGIONS,
    STATUSES,
    TARGETS,
    ZIP_PATTERN,
    Domain,
    Minimum,
    Table,
)
from registry.base import SNAPSHOT, Inputs, query
from registry.tables import days, days_early, delta, sales
from registry.views import region_sql


def _listed(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _row_sql(table: str, rule: str, key: str, value: str, source: str, where: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, {key} AS key, {value} AS value, "
        f"CAST(1 AS BIGINT) AS n_rows FROM {source} WHERE {where}"
    )


_LINE_KEY = "i.purchase_id || '|' || i.item_id || '|' || i.size_id"
_CANDIDATES = """purchases_items i LEFT JOIN purchases_status s ON s.purchase_id = i.purchase_id
LEFT JOIN prices r ON r.item_id = i.item_id AND r.size_id = i.size_id LEFT JOIN purchases p ON p.id = i.purchase_id
LEFT JOIN dim_time_early d ON d.date = p.order_date"""


def candidates(t: Inputs) -> DataFrame:
    """fact_sales rows by left joins: gaps stay as nulls."""
    calendar = F.broadcast(days_early(t).select(F.col("date").alias("order_date"), "date_id"))
    header = t.purchases.select(F.col("id").alias("purchase_id"), "customer_id", "store_id", "order_date").join(
        calendar, "order_date", "left"
    )
    return (
        t.purchases_items.drop("created_at")
        .join(t.purchases_status.select("purchase_id", F.col("status").alias("purchase_status")), "purchase_id", "left")
        .join(header, "purchase_id", "left")
        .join(t.prices.drop("created_at"), ["item_id", "size_id"], "left")
        .withColumn("line_value", F.col("value").cast("double") * F.col("quantity"))
        .withColumnRenamed("quantity", "quantity_sold")
        .select(*TARGETS["fact_sales"].names)
    )


_NULLABLE = {"date_id": "d.date_id", "purchase_status": "s.status", "line_value": "r.value"}


@query(
    "dq_not_null",
    "\nUNION ALL ".join(
        _row_sql("fact_sales", f"not_null:{c}", _LINE_KEY, "CAST(NULL AS VARCHAR)", _CANDIDATES, f"{e} IS NULL")
        for c, e in _NULLABLE.items()
    ),
)
def dq_not_null(t: Inputs) -> DataFrame:
    return dq.row_violations(candidates(t), TARGETS["fact_sales"], ("not_null",))


@query(
    "dq_null_date_id",
    f"SELECT count(*) FILTER (d.date_id IS NULL) AS n_missing, bool_or(d.date_id IS NULL) AS any_missing FROM {_CANDIDATES}",
)
def dq_null_date_id(t: Inputs) -> DataFrame:
    missing = F.col("date_id").isNull()
    return candidates(t).agg(F.count_if(missing).alias("n_missing"), F.bool_or(missing).alias("any_missing"))


@query(
    "dq_primary_key",
    """SELECT 'purchases_items' AS table_name, 'primary_key' AS rule, key, key AS value, n_rows FROM
(SELECT l_orderkey || '|' || l_partkey || '|' || size_id AS key, count(*) AS n_rows FROM demand GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stores_addresses', 'unique:store_id', CAST(store_id AS VARCHAR), CAST(store_id AS VARCHAR), count(*)
FROM stores_addresses GROUP BY store_id HAVING count(*) > 1""",
)
def dq_primary_key(t: Inputs) -> DataFrame:
    lines = t.demand.select(F.col("l_orderkey").alias("purchase_id"), F.col("l_partkey").alias("item_id"), "size_id")
    return dq.duplicate_keys(lines, SOURCES["purchases_items"]).unionByName(
        dq.duplicate_keys(t.stores_addresses, SOURCES["stores_addresses"], ["store_id"])
    )


@query(
    "dq_unique_date",
    """SELECT 'dim_time' AS table_name, 'unique:date' AS rule, CAST(date AS VARCHAR) AS key, CAST(date AS VARCHAR) AS value, count(*) AS n_rows
FROM (SELECT date FROM dim_time_early UNION ALL SELECT DISTINCT order_date FROM delta) GROUP BY date HAVING count(*) > 1""",
)
def dq_unique_date(t: Inputs) -> DataFrame:
    both = days_early(t).unionByName(dims.dim_time(delta(t)))
    return dq.duplicate_keys(both, TARGETS["dim_time"], ["date"])


_REFERRING = ("purchases", "purchases_status", "purchases_items", "stores_addresses", "customers_addresses", "phones_customers")


def _orphan_sql(name: str, reference) -> str:
    key = " || '|' || ".join(f"CAST(c.{c} AS VARCHAR)" for c in reference.columns)
    match = " AND ".join(f"p.{p} = c.{c}" for c, p in zip(reference.columns, reference.parent_columns, strict=True))
    given = " AND ".join(f"c.{c} IS NOT NULL" for c in reference.columns)
    rule = f"foreign_key:{','.join(reference.columns)}->{reference.parent}"
    return (
        f"SELECT '{name}' AS table_name, '{rule}' AS rule, {key} AS key, {key} AS value, count(*) AS n_rows FROM {name} c "
        f"WHERE {given} AND NOT EXISTS (SELECT 1 FROM {reference.parent} p WHERE {match}) GROUP BY 3"
    )


@query(
    "dq_fk_orphans",
    "\nUNION ALL ".join(_orphan_sql(n, r) for n in _REFERRING for r in SOURCES[n].references if len(r.columns) == 1),
)
def dq_fk_orphans(t: Inputs) -> DataFrame:
    return union_all(
        [
            dq.orphans(getattr(t, n), SOURCES[n], r, getattr(t, r.parent))
            for n in _REFERRING
            for r in SOURCES[n].references
            if len(r.columns) == 1
        ]
    )


_PAIR = next(r for r in SOURCES["purchases_items"].references if len(r.columns) == 2)


@query("dq_fk_composite", _orphan_sql("purchases_items", _PAIR))
def dq_fk_composite(t: Inputs) -> DataFrame:
    return dq.orphans(t.purchases_items, SOURCES["purchases_items"], _PAIR, t.items_sizes)


@query(
    "dq_state_domain",
    _row_sql(
        "addresses",
        "domain:state",
        "CAST(id AS VARCHAR)",
        "state",
        "(SELECT c_custkey AS id, substr(c_mktsegment, 1, 2) AS state FROM customer)",
        f"state NOT IN ({_listed(STATE_REGIONS)})",
    ),
)
def dq_state_domain(t: Inputs) -> DataFrame:
    # the first letters of a market segment: some are state codes, some are not
    rows = t.raw("customer").select(F.col("c_custkey").alias("id"), F.substring("c_mktsegment", 1, 2).alias("state"))
    blank = [F.lit("00000").alias(c) if c == "zip_code" else F.lit("-").alias(c) for c in SOURCES["addresses"].names]
    shaped = rows.select(*("id" if c == "id" else "state" if c == "state" else b for c, b in zip(SOURCES["addresses"].names, blank, strict=True)))
    return dq.row_violations(shaped, SOURCES["addresses"], ("domain",))


_REGION_ROWS = f"""(SELECT c_custkey AS id, coalesce({region_sql('substr(c_mktsegment, 1, 2)')}, c_mktsegment) AS region FROM customer)"""


@query(
    "dq_region_domain",
    _row_sql(
        "dim_stores", "domain:region", "CAST(id AS VARCHAR)", "region", _REGION_ROWS, f"region NOT IN ({_listed(REGIONS)})"
    ),
)
def dq_region_domain(t: Inputs) -> DataFrame:
    state = F.substring("c_mktsegment", 1, 2)
    rows = t.raw("customer").select(
        F.col("c_custkey").alias("store_id"),
        F.lit("SP").alias("state"),
        F.coalesce(region_of(state), F.col("c_mktsegment")).alias("region"),
    )
    return dq.row_violations(rows, TARGETS["dim_stores"], ("domain",))


_STATUS_ROWS = """(SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'Pending' WHEN 'O' THEN 'Sent' ELSE o_orderstatus END AS status FROM orders)"""


@query(
    "dq_status_domain",
    _row_sql(
        "purchases_status",
        "domain:status",
        "CAST(o_orderkey AS VARCHAR)",
        "status",
        _STATUS_ROWS,
        f"status NOT IN ({_listed(STATUSES)})",
    ),
)
def dq_status_domain(t: Inputs) -> DataFrame:
    # code F is left untranslated
    code = F.col("o_orderstatus")
    word = F.when(code == "P", "Pending").when(code == "O", "Sent").otherwise(code)
    rows = t.raw("orders").select(F.col("o_orderkey").alias("purchase_id"), word.alias("status"))
    return dq.row_violations(rows, SOURCES["purchases_status"], ("domain",))


@query(
    "dq_phone_type_domain",
    _row_sql(
        "phones",
        "domain:phone_type",
        "CAST(c_custkey AS VARCHAR)",
        "phone_type",
        "(SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Commercial' WHEN 'MACHINERY' THEN NULL ELSE c_mktsegment END AS phone_type FROM customer)",
        "phone_type NOT IN ('Residential', 'Mobile', 'Commercial')",
    ),
)
def dq_phone_type_domain(t: Inputs) -> DataFrame:
    kind = F.col("c_mktsegment")
    word = F.when(kind == "BUILDING", "Commercial").when(kind != "MACHINERY", kind)
    rows = t.raw("customer").select(F.col("c_custkey").alias("id"), word.alias("phone_type"))
    return dq.row_violations(rows, SOURCES["phones"], ("domain",))


@query(
    "dq_catalog_domain",
    """SELECT 'sizes' AS table_name, 'catalog_domain:size' AS rule, size AS key, size AS value, count(*) AS n_rows FROM sizes
WHERE size NOT IN (SELECT unnest(string_split(tamanhos_validos, ';')) FROM catalog) GROUP BY size
UNION ALL SELECT 'categories', 'catalog_domain:name', name, name, count(*) FROM categories
WHERE name NOT IN (SELECT categoria FROM catalog) GROUP BY name""",
)
def dq_catalog_domain(t: Inputs) -> DataFrame:
    from martloom.plans.catalog import exploded_sizes

    lengths = exploded_sizes(t.catalog).select("size").distinct()
    return dq.outside_domain(t.sizes, SOURCES["sizes"], "size", lengths).unionByName(
        dq.outside_domain(t.categories, SOURCES["categories"], "name", t.catalog.select("categoria").distinct())
    )


_STOCK_LEFT = """(SELECT v.item_id, v.size_id, v.store_id, v.quantity - sum(d.quantity) AS quantity FROM inventory v
JOIN demand d ON d.l_partkey = v.item_id AND d.size_id = v.size_id AND d.l_suppkey = v.store_id GROUP BY v.item_id, v.size_id, v.store_id, v.quantity)"""


@query(
    "dq_ranges",
    _row_sql(
        "inventory",
        "minimum:quantity",
        "item_id || '|' || size_id || '|' || store_id",
        "CAST(CAST(quantity AS BIGINT) AS VARCHAR)",
        _STOCK_LEFT,
        "quantity < 0",
    )
    + "\nUNION ALL "
    + _row_sql(
        "purchases_items",
        "minimum:quantity",
        "l_orderkey || '|' || l_partkey || '|' || size_id",
        "CAST(quantity - 25 AS VARCHAR)",
        "demand",
        "quantity - 25 <= 0",
    )
    + "\nUNION ALL "
    + _row_sql("prices", "minimum:value", "item_id || '|' || size_id", "CAST(value - 1000 AS VARCHAR)", "prices", "value - 1000 <= 0")
    + "\nUNION ALL "
    + _row_sql(
        "fact_sales",
        "minimum:line_value",
        "purchase_id || '|' || item_id || '|' || size_id",
        "CAST(CAST(25 - quantity_sold AS DOUBLE) AS VARCHAR)",
        "fact_sales",
        "25 - quantity_sold < 0",
    )
    + "\nUNION ALL "
    + _row_sql(
        "fact_sales",
        "minimum:quantity_sold",
        "purchase_id || '|' || item_id || '|' || size_id",
        "CAST(quantity_sold - 25 AS VARCHAR)",
        "fact_sales",
        "quantity_sold - 25 < 0",
    )
    + "\nUNION ALL "
    + _row_sql(
        "fact_inventory",
        "minimum:quantity_in_stock",
        "item_id || '|' || size_id || '|' || store_id || '|' || date_id",
        "CAST(quantity_in_stock - 50 AS VARCHAR)",
        "fact_inventory",
        "quantity_in_stock - 50 < 0",
    ),
)
def dq_ranges(t: Inputs) -> DataFrame:
    # stock driven below zero by unchecked demand; quantities, prices and stock moved down; values turned by the quantity
    keys = ["item_id", "size_id", "store_id"]
    lines = t.demand.withColumnsRenamed({"l_partkey": "item_id", "l_suppkey": "store_id", "l_orderkey": "purchase_id"})
    negative = apply_decrements(t.inventory, lines, keys)
    moved = lines.withColumn("quantity", F.col("quantity") - 25)
    cheap = t.prices.withColumn("value", F.col("value") - 1000)
    d = days(t)
    sold = sales(t, t.purchases, d).withColumns(
        {"line_value": (25 - F.col("quantity_sold")).cast("double"), "quantity_sold": F.col("quantity_sold") - 25}
    )
    stock = facts.fact_inventory(t.inventory, facts.date_id_of(d, SNAPSHOT)).withColumn("quantity_in_stock", F.col("quantity_in_stock") - 50)
    checked = [(negative, SOURCES["inventory"]), (moved, SOURCES["purchases_items"]), (cheap, SOURCES["prices"])]
    checked += [(sold, TARGETS["fact_sales"]), (stock, TARGETS["fact_inventory"])]
    return union_all([dq.row_violations(df, table, ("minimum",)) for df, table in checked])


@query(
    "dq_zip_format",
    _row_sql(
        "addresses",
        "pattern:zip_code",
        "CAST(id AS VARCHAR)",
        "zip_code",
        "addresses",
        f"NOT regexp_matches(zip_code, '{ZIP_PATTERN}')",
    ),
)
def dq_zip_format(t: Inputs) -> DataFrame:
    return dq.row_violations(t.addresses, SOURCES["addresses"], ("pattern",))


@query(
    "dq_phone_format",
    _row_sql(
        "phones",
        "pattern:number",
        "CAST(id AS VARCHAR)",
        "number",
        "phones",
        f"NOT regexp_matches(number, '{PHONE_PATTERN}')",
    ),
)
def dq_phone_format(t: Inputs) -> DataFrame:
    return dq.row_violations(t.phones, SOURCES["phones"], ("pattern",))


@query(
    "dq_max_length",
    _row_sql("items", "max_length:name", "CAST(doc_id AS VARCHAR)", "text", "documents", "length(text) > 50"),
)
def dq_max_length(t: Inputs) -> DataFrame:
    rows = t.raw("documents").select(F.col("doc_id").alias("id"), F.col("text").alias("name"))
    return dq.row_violations(rows, SOURCES["items"], ("max_length",))


_SPLIT_BROKEN = f"""
judged AS (SELECT p.id, p.customer_id, p.store_id, p.order_date,
  list_filter([CASE WHEN store_id IS NULL THEN 'not_null:store_id' END,
    CASE WHEN p.customer_id IS NOT NULL AND c.customer_id IS NULL THEN 'foreign_key:customer_id->customers' END,
    CASE WHEN p.store_id IS NOT NULL AND s.id IS NULL THEN 'foreign_key:store_id->stores' END], lambda r: r IS NOT NULL) AS broken
FROM (SELECT o_orderkey AS id, o_custkey AS customer_id, store_id, CAST(o_orderdate AS DATE) AS order_date FROM orders
      LEFT JOIN (SELECT l_orderkey, max(l_suppkey) + 1 AS store_id FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey) p
LEFT JOIN customers c ON c.customer_id = p.customer_id LEFT JOIN stores s ON s.id = p.store_id)"""


@query(
    "dq_split_rows",
    f"""WITH {_SPLIT_BROKEN}
SELECT id, len(broken) = 0 AS good, array_to_string(broken, ',') AS broken_rules FROM judged""",
)
def dq_split_rows(t: Inputs) -> DataFrame:
    # orders without lines have no store; the store after the last one does not exist
    seller = (
        t.raw("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg((F.max("l_suppkey") + 1).alias("store_id"))
    )
    rows = (
        t.raw("orders")
        .join(seller, "o_orderkey", "left")
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("o_custkey").alias("customer_id"),
            "store_id",
            F.to_date("o_orderdate").alias("order_date"),
            F.col("o_orderdate").alias("created_at"),
        )
    )
    good, rejected = dq.split(rows, SOURCES["purchases"], {"customers": t.customers, "stores": t.stores})
    return good.select("id", F.lit(True).alias("good"), F.lit("").alias("broken_rules")).unionByName(
        rejected.select("id", F.lit(False).alias("good"), F.array_join("broken_rules", ",").alias("broken_rules"))
    )


_REPEATED_STATUS = """
given AS (SELECT l_orderkey AS purchase_id, CASE l_returnflag WHEN 'A' THEN 'Sent' WHEN 'N' THEN 'Pending' ELSE 'Lost' END AS status,
  CAST(l_shipdate AS DATE) AS day FROM lineitem)"""


@query(
    "dq_split_duplicates",
    f"""WITH {_REPEATED_STATUS},
ranked AS (SELECT *, status = 'Lost' AS wrong, row_number() OVER (PARTITION BY purchase_id, status = 'Lost' ORDER BY status, day) AS n FROM given)
SELECT purchase_id, status, day, NOT wrong AND n = 1 AS good, CASE WHEN wrong THEN 'domain:status' WHEN n > 1 THEN 'primary_key' ELSE '' END AS broken_rules
FROM ranked""",
)
def dq_split_duplicates(t: Inputs) -> DataFrame:
    """The state of each line of an order stands for the order's state, so most orders have several."""
    state = F.when(F.col("l_returnflag") == "A", "Sent").when(F.col("l_returnflag") == "N", "Pending").otherwise("Lost")
    rows = t.raw("lineitem").select(F.col("l_orderkey").alias("purchase_id"), state.alias("status"), F.to_date("l_shipdate").alias("created_at"))
    good, rejected = dq.split(rows, SOURCES["purchases_status"], unique=True)
    both = good.withColumn("broken_rules", F.array().cast("array<string>")).unionByName(rejected)
    rules = F.array_join("broken_rules", ",")
    return both.select("purchase_id", "status", F.col("created_at").alias("day"), (rules == "").alias("good"), rules.alias("broken_rules"))


def _all_rules_sql(table: Table) -> list[str]:
    name, key = table.name, " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in table.key)
    broken = [(f"not_null:{c.name}", c.name, f"{c.name} IS NULL") for c in table.columns if not c.nullable]
    broken += [(f"max_length:{c.name}", c.name, f"length({c.name}) > {c.length}") for c in table.columns if c.length]
    for check in table.checks:
        c = check.column
        if isinstance(check, Domain):
            broken.append((f"domain:{c}", c, f"{c} NOT IN ({_listed(check.values)})"))
        elif isinstance(check, Minimum):
            broken.append((f"minimum:{c}", c, f"{c} {'<=' if check.strict else '<'} {check.bound}"))
        else:
            broken.append((f"pattern:{c}", c, f"NOT regexp_matches({c}, '{check.regex}')"))
    parts = [_row_sql(name, rule, key, f"CAST({c} AS VARCHAR)", name, where) for rule, c, where in broken]
    parts.append(
        f"SELECT '{name}', 'primary_key', {key}, {key}, count(*) FROM {name} GROUP BY {', '.join(table.key)} HAVING count(*) > 1"
    )
    return parts + [_orphan_sql(name, r) for r in table.references]


@query("dq_all_rules", "\nUNION ALL ".join(part for table in SOURCES.values() for part in _all_rules_sql(table)))
def dq_all_rules(t: Inputs) -> DataFrame:
    t.keep("purchases", "purchases_items", "inventory")  # each is scanned twice, and purchases as a parent, too
    return dq.check(t.bundle(*SOURCES), SOURCES)
