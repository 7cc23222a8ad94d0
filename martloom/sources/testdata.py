"""The driver's test tables seen as the 17 source tables (rules in FIXTURES.md)."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.text import customer_email, store_email
from martloom.schema import STATE_REGIONS
from martloom.sources.tables import read_files

RAW = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}
START = "timestamp_ntz'2025-01-01 00:00:00'"


@lru_cache(maxsize=None)
def _footer_schema(path: str) -> T.StructType:
    return SparkSession.active().read.parquet(path).schema


def _shape(df: DataFrame, name: str) -> DataFrame:
    # files may hold a wider or narrower integer than declared; equal types cost nothing
    fields = (field.split(" ") for field in RAW[name].split(", "))
    return df.select(*(F.col(column).cast(kind).alias(column) for column, kind in fields))


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return _shape(spark.read.schema(_footer_schema(path)).parquet(path), name)


def raw_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream; a glob, so that it may be one file or a folder of files."""
    schema = _footer_schema(f"{sf_dir}/{name}.parquet")
    return _shape(read_files(spark, f"{sf_dir}/{name}.parque[t]", schema), name)


def _start_plus(days: str = "0") -> Column:
    return F.expr(f"{START} + make_dt_interval(cast({days} as int))").alias("created_at")


def _state(shift: int) -> Column:
    codes = F.array(*(F.lit(s) for s in STATE_REGIONS))
    return F.get(codes, (F.col("s_nationkey") + shift) % len(STATE_REGIONS))


class _Views:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _raw(self, name: str) -> DataFrame:
        return raw(self.spark, self.sf_dir, name)

    def categories(self) -> DataFrame:
        types = self._raw("part").select(F.col("p_type").alias("name")).distinct()
        rank = F.row_number().over(Window.orderBy("name")).cast("bigint")  # part types are a fixed short list
        return types.select(rank.alias("id"), "name", _start_plus())

    def items(self) -> DataFrame:
        kinds = self.categories().select(F.col("id").alias("category_id"), F.col("name").alias("p_type"))
        return (
            self._raw("part")
            .join(kinds, "p_type")
            .select(
                F.col("p_partkey").alias("id"),
                F.col("p_name").alias("name"),
                "category_id",
                _start_plus("p_partkey % 30"),
            )
        )

    def sizes(self) -> DataFrame:
        return (
            self._raw("part")
            .select(F.col("p_size").cast("bigint").alias("id"))
            .distinct()
            .select("id", F.col("id").cast("string").alias("size"), _start_plus())
        )

    def _parts(self) -> DataFrame:
        return self._raw("part").select(
            F.col("p_partkey").alias("item_id"),
            F.col("p_size").cast("bigint").alias("size_id"),
            F.col("p_retailprice").cast("decimal(10,2)").alias("value"),
            _start_plus("p_partkey % 30"),
        )

    def items_sizes(self) -> DataFrame:
        return self._parts().where("item_id % 50 <> 0").drop("value")

    def prices(self) -> DataFrame:
        return self._parts().where("item_id % 97 <> 0")

    def stores(self) -> DataFrame:
        return self._raw("supplier").select(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("name"),
            store_email(F.col("s_name")).alias("email"),
            _start_plus("s_suppkey % 30"),
        )

    def _places(self) -> DataFrame:
        # every store has address 2s; every tenth also 2s + 1, a day younger
        extra = F.when(F.col("s_suppkey") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return self._raw("supplier").select("*", F.explode(extra).alias("nth"))

    def stores_addresses(self) -> DataFrame:
        return self._places().select(
            F.col("s_suppkey").alias("store_id"),
            (F.col("s_suppkey") * 2 + F.col("nth")).alias("address_id"),
            _start_plus("s_suppkey % 30 + nth"),
        )

    def addresses(self) -> DataFrame:
        nations = self._raw("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        key = F.col("s_suppkey")
        tail = F.when(key % 13 == 0, "-00").otherwise("-000")
        return (
            self._places()
            .join(nations, "s_nationkey", "left")
            .select(
                (key * 2 + F.col("nth")).alias("id"),
                F.concat(F.lit("Rua "), key.cast("string")).alias("street"),
                (key % 1000).cast("string").alias("number"),
                F.when(key % 4 != 0, F.concat(F.lit("Sala "), (key % 50).cast("string"))).alias("complement"),
                F.lit("Centro").alias("neighborhood"),
                F.col("n_name").alias("city"),
                F.when(F.col("nth") == 0, _state(0)).otherwise(_state(1)).alias("state"),
                F.concat(F.lpad((key % 100000).cast("string"), 5, "0"), tail).alias("zip_code"),
                F.lit("Brasil").alias("country"),
                _start_plus("s_suppkey % 30 + nth"),
            )
        )

    def customers(self) -> DataFrame:
        return self._raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("full_name"),
            customer_email(F.col("c_name")).alias("email"),
            _start_plus("c_custkey % 30"),
        )

    def customers_addresses(self) -> DataFrame:
        return self._raw("customer").select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_nationkey") * 2).cast("bigint").alias("address_id"),
            _start_plus("c_custkey % 30"),
        )

    def phones(self) -> DataFrame:
        key = F.col("c_custkey")
        kinds = F.array(F.lit("Residential"), F.lit("Mobile"), F.lit("Commercial"))
        return self._raw("customer").select(
            key.alias("id"),
            F.get(kinds, (key % 3).cast("int")).alias("phone_type"),
            F.concat(
                (key % 89 + 11).cast("string"),
                F.lit("-9"),
                F.lpad((key % 10000).cast("string"), 4, "0"),
                F.lpad((key * 7 % 10000).cast("string"), 4, "0"),
            ).alias("number"),
        )

    def phones_customers(self) -> DataFrame:
        return self._raw("customer").select(
            F.col("c_custkey").alias("phone_id"), F.col("c_custkey").alias("customer_id")
        )

    def phones_stores(self) -> DataFrame:
        return self._raw("supplier").select(
            F.col("s_suppkey").alias("phone_id"), F.col("s_suppkey").alias("store_id")
        )

    def purchases(self, orders: DataFrame | None = None) -> DataFrame:
        seller = (
            self._raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.min("l_suppkey").alias("store_id"))
        )
        late = F.expr("o_orderdate + make_dt_interval(if(o_orderkey % 20 = 0, 400, 0))")
        return (
            (self._raw("orders") if orders is None else orders)
            .join(seller, "o_orderkey")
            .select(
                F.col("o_orderkey").alias("id"),
                F.when(F.col("o_custkey") % 10 != 3, F.col("o_custkey")).alias("customer_id"),
                "store_id",
                F.to_date("o_orderdate").alias("order_date"),
                late.alias("created_at"),
            )
        )

    def purchases_items(self) -> DataFrame:
        sizes = self._raw("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_size").cast("bigint").alias("size_id")
        )
        return (
            self._raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("purchase_id"), F.col("l_partkey").alias("item_id"))
            .agg(
                F.sum(F.col("l_quantity").cast("int")).cast("int").alias("quantity"),
                F.max("l_shipdate").alias("created_at"),
            )
            .join(sizes, "item_id")
            .select("purchase_id", "item_id", "size_id", "quantity", "created_at")
        )

    def purchases_status(self) -> DataFrame:
        word = (
            F.when(F.col("o_orderstatus") == "P", "Pending")
            .when(F.col("o_orderstatus") == "O", "Sent")
            .when(F.col("o_orderstatus") == "F", "Delivered")
        )
        return (
            self._raw("orders")
            .where("o_orderkey % 100 <> 7")
            .select(F.col("o_orderkey").alias("purchase_id"), word.alias("status"), F.col("o_orderdate").alias("created_at"))
        )

    def inventory(self) -> DataFrame:
        sizes = self._raw("part").select(
            F.col("p_partkey").alias("item_id"), F.col("p_size").cast("bigint").alias("size_id")
        )
        return (
            self._raw("lineitem")
            .select(F.col("l_partkey").alias("item_id"), F.col("l_suppkey").alias("store_id"))
            .distinct()
            .join(sizes, "item_id")
            .select(
                "item_id",
                "size_id",
                "store_id",
                ((F.col("item_id") * 7 + F.col("store_id") * 13) % 100).alias("quantity"),
                _start_plus("(item_id + store_id) % 30"),
            )
        )

    def catalog(self) -> DataFrame:
        key = F.col("p_partkey")
        cell = F.when(key % 3 == 0, "P;M;G").when(key % 3 == 1, "Unico").otherwise("100ml;200ml")
        return self._raw("part").select(
            F.concat("p_name", F.lit(" "), key.cast("string")).alias("nome_item"),
            F.col("p_type").alias("categoria"),
            cell.alias("tamanhos_validos"),
            key.alias("position"),
        )

    def demand(self, lines: DataFrame | None = None) -> DataFrame:
        """Order lines as stock demand, with the five columns that order them."""
        sizes = self._raw("part").select(
            F.col("p_partkey").alias("l_partkey"), F.col("p_size").cast("bigint").alias("size_id")
        )
        return (
            (self._raw("lineitem") if lines is None else lines)
            .select(
                "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("int").alias("quantity")
            )
            .join(sizes, "l_partkey")
        )


def view(spark: SparkSession, sf_dir: str, name: str, base: DataFrame | None = None) -> DataFrame:
    """One view; ``base`` stands in for the raw table that purchases or demand start from."""
    builder: Callable[..., DataFrame] = getattr(_Views(spark, sf_dir), name)
    return builder() if base is None else builder(base)


def bundle(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {n: view(spark, sf_dir, n) for n in names}
