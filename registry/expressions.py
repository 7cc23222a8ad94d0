"""Queries on scalar functions, over whole columns of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions import calendar as cal
from martloom.functions import text as tx
from martloom.operators.audit import union_all
from registry.base import Inputs, query
from registry.views import CALENDAR, customer_email_sql, normalize_sql, parts_sql, region_sql, store_email_sql

# Names from several columns: plain, with particles, blank, only particles, and whole documents.
_NAMES_SQL = """
names AS (
  SELECT 'plain' AS origin, c_custkey AS key, c_name AS name FROM customer
  UNION ALL SELECT 'particle', c_custkey, c_mktsegment || ' da  ' || c_name || ' DOS ' || lower(c_mktsegment) FROM customer
  UNION ALL SELECT 'blank', c_custkey, repeat(' ', c_nationkey) FROM customer
  UNION ALL SELECT 'particles', c_custkey, repeat('de ', c_nationkey) FROM customer
  UNION ALL SELECT 'null', c_custkey, nullif(c_mktsegment, 'BUILDING') FROM customer
  UNION ALL SELECT 'part', p_partkey, p_name FROM part
  UNION ALL SELECT 'store', s_suppkey, ' -' || s_name || '! ' FROM supplier
  UNION ALL SELECT 'document', doc_id, text FROM documents)"""


def _names(t: Inputs) -> DataFrame:
    customer, key, kind = t.raw("customer"), F.col("c_custkey"), F.col("c_mktsegment")

    def rows(df: DataFrame, origin: str, key, name) -> DataFrame:
        return df.select(F.lit(origin).alias("origin"), key.alias("key"), name.alias("name"))

    composed = F.concat(kind, F.lit(" da  "), F.col("c_name"), F.lit(" DOS "), F.lower(kind))
    return union_all(
        [
            rows(customer, "plain", key, F.col("c_name")),
            rows(customer, "particle", key, composed),
            rows(customer, "blank", key, F.expr("repeat(' ', c_nationkey)")),
            rows(customer, "particles", key, F.expr("repeat('de ', c_nationkey)")),
            rows(customer, "null", key, F.nullif(kind, F.lit("BUILDING"))),
            rows(t.raw("part"), "part", F.col("p_partkey"), F.col("p_name")),
            rows(t.raw("supplier"), "store", F.col("s_suppkey"), F.concat(F.lit(" -"), F.col("s_name"), F.lit("! "))),
            rows(t.raw("documents"), "document", F.col("doc_id"), F.col("text")),
        ]
    )


@query("scl_normalize_name", f"WITH {_NAMES_SQL} SELECT origin, key, {normalize_sql('name')} AS normalized FROM names")
def scl_normalize_name(t: Inputs) -> DataFrame:
    return _names(t).select("origin", "key", tx.normalize_name(F.col("name")).alias("normalized"))


@query(
    "scl_customer_email",
    f"""WITH {_NAMES_SQL}, split_names AS (SELECT origin, key, {parts_sql('name')} AS parts FROM names)
SELECT origin, key, {customer_email_sql('parts')} AS email FROM split_names""",
)
def scl_customer_email(t: Inputs) -> DataFrame:
    return _names(t).select("origin", "key", tx.customer_email(F.col("name")).alias("email"))


@query("scl_store_email", f"WITH {_NAMES_SQL} SELECT origin, key, {store_email_sql('name')} AS email FROM names")
def scl_store_email(t: Inputs) -> DataFrame:
    return _names(t).select("origin", "key", tx.store_email(F.col("name")).alias("email"))


@query(
    "scl_parse_date",
    """SELECT o_orderkey, swapped, TRY_CAST(swapped AS DATE) AS parsed FROM
(SELECT o_orderkey, strftime(o_orderdate, '%Y-%d-%m') AS swapped FROM orders)""",
)
def scl_parse_date(t: Inputs) -> DataFrame:
    # day and month change places: every day after the 12th is no date
    swapped = t.raw("orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-dd-MM").alias("swapped"))
    return swapped.withColumn("parsed", cal.parse_date(F.col("swapped")))


@query(
    "scl_calendar",
    f"SELECT l_orderkey, date, {CALENDAR} FROM (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS date FROM lineitem)",
)
def scl_calendar(t: Inputs) -> DataFrame:
    dated = t.raw("lineitem").select("l_orderkey", F.to_date("l_shipdate").alias("date"))
    return dated.select("*", *cal.calendar_parts(F.col("date")))


_STAMPS_SQL = """
stamps AS (SELECT 'event' AS origin, event_id AS key, ts FROM events
  UNION ALL SELECT 'order', o_orderkey, o_orderdate + INTERVAL 12 HOUR FROM orders)"""
_ZONE = "'America/Sao_Paulo'"
_UTC_SQL = f"timezone('UTC', timezone({_ZONE}, ts))"
_LOCAL_SQL = f"timezone({_ZONE}, timezone('UTC', ts))"


@query(
    "scl_timezone",
    f"""WITH {_STAMPS_SQL} SELECT origin, key, {_UTC_SQL} AS utc, {_LOCAL_SQL} AS local_time,
strftime({_UTC_SQL}, '%Y-%m-%d %H:%M:%S') AS utc_text FROM stamps""",
)
def scl_timezone(t: Inputs) -> DataFrame:
    noon = F.expr("o_orderdate + INTERVAL 12 HOURS")
    stamps = (
        t.raw("events")
        .select(F.lit("event").alias("origin"), F.col("event_id").alias("key"), "ts")
        .unionByName(
            t.raw("orders").select(F.lit("order").alias("origin"), F.col("o_orderkey").alias("key"), noon.alias("ts"))
        )
    )
    utc = cal.local_to_utc(F.col("ts"))
    return stamps.select(
        "origin",
        "key",
        utc.alias("utc"),
        cal.utc_to_local(F.col("ts")).alias("local_time"),
        cal.stamp_text(utc).alias("utc_text"),
    )


@query(
    "scl_state_region",
    f"""WITH codes AS (SELECT 'address' AS origin, id AS key, state FROM addresses
  UNION ALL SELECT 'customer', c_custkey, substr(c_mktsegment, 1, 2) FROM customer)
SELECT origin, key, state, {region_sql('state')} AS region FROM codes""",
)
def scl_state_region(t: Inputs) -> DataFrame:
    codes = t.addresses.select(F.lit("address").alias("origin"), F.col("id").alias("key"), "state").unionByName(
        t.raw("customer").select(
            F.lit("customer").alias("origin"),
            F.col("c_custkey").alias("key"),
            F.substring("c_mktsegment", 1, 2).alias("state"),
        )
    )
    return codes.withColumn("region", tx.region_of(F.col("state")))


@query(
    "scl_split_explode",
    """SELECT nome_item, position, CAST(generate_subscripts(cells, 1) - 1 AS INTEGER) AS nth, unnest(cells) AS size
FROM (SELECT nome_item, position, string_split(tamanhos_validos, ';') AS cells FROM catalog)""",
)
def scl_split_explode(t: Inputs) -> DataFrame:
    from martloom.plans.catalog import exploded_sizes

    return exploded_sizes(t.catalog)


@query("scl_nan_to_null", "SELECT id AS purchase_id, customer_id FROM purchases")
def scl_nan_to_null(t: Inputs) -> DataFrame:
    floats = t.purchases.select(
        F.col("id").alias("purchase_id"),
        F.coalesce(F.col("customer_id").cast("double"), F.lit(float("nan"))).alias("customer_id"),
    )
    return floats.withColumn("customer_id", tx.nan_to_null(F.col("customer_id")))
