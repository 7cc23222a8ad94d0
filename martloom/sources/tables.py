"""Reading the source tables: parquet, JDBC, CSV catalog; full and since a mark."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.calendar import zoneless
from martloom.operators.keys import dense_ids
from martloom.schema import SLICED_SOURCES, SOURCES

CATALOG_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("nome_item", "categoria", "tamanhos_validos")]
)


def read_parquet(spark: SparkSession, root: str, names: Iterable[str] = tuple(SOURCES)) -> dict[str, DataFrame]:
    """The source bundle from ``<root>/<table>``, with declared schemas and nothing inferred."""
    return {n: spark.read.schema(SOURCES[n].struct).parquet(f"{root}/{n}") for n in names}


@dataclass(frozen=True)
class JdbcSplit:
    """How one large table is read in parallel."""

    column: str
    low: int
    high: int
    partitions: int


FETCH_ROWS = 10_000  # rows a database reader asks for at a time


def jdbc_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, split: JdbcSplit | None = None
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "preferTimestampNTZ": "true", "fetchsize": str(FETCH_ROWS), **(properties or {})}
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.low),
            "upperBound": str(split.high),
            "numPartitions": str(split.partitions),
        }
    return options


def read_jdbc(
    spark: SparkSession,
    url: str,
    properties: Mapping[str, str] | None = None,
    splits: Mapping[str, JdbcSplit] | None = None,
    names: Iterable[str] = tuple(SOURCES),
) -> dict[str, DataFrame]:
    """The source bundle from a database; filters such as the created_at slice are pushed to it."""
    splits = splits or {}
    bundle = {}
    for n in names:
        df = spark.read.format("jdbc").options(**jdbc_options(url, n, properties, splits.get(n))).load()
        bundle[n] = df.select(*(F.col(c.name).cast(c.type).alias(c.name) for c in SOURCES[n].columns))
    return bundle


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, batch_rows: int = 1000
) -> None:
    """Append over JDBC, ``batch_rows`` rows per statement."""
    options = {**jdbc_options(url, table, properties), "batchsize": str(batch_rows)}
    for reading in ("preferTimestampNTZ", "fetchsize"):
        options.pop(reading)
    df.write.format("jdbc").options(**options).mode("append").save()


def read_catalog_csv(spark: SparkSession, path: str) -> DataFrame:
    """Catalog rows with their ``position`` in file order, from 0."""
    rows = spark.read.schema(CATALOG_SCHEMA).option("header", True).csv(path)
    place = ["_file", "_block", "_row"]
    placed = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return dense_ids(placed, place, "position", start=0).drop(*place)


def read_files(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 0) -> DataFrame:
    """File stream over a folder or glob of parquet files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def created_between(df: DataFrame, low, high=None) -> DataFrame:
    """Rows with ``low < created_at <= high``; the filter reaches parquet and JDBC scans."""
    rows = df if low is None else df.where(F.col("created_at") > zoneless(low))
    return rows if high is None else rows.where(F.col("created_at") <= zoneless(high))


def extract(tables: Mapping[str, DataFrame], low=None, high=None) -> dict[str, DataFrame]:
    """All tables when no mark is given, else the slice ``(low, high]`` of the 13 sliced ones."""
    if low is None and high is None:
        return dict(tables)
    return {n: created_between(tables[n], low, high) for n in SLICED_SOURCES if n in tables}
