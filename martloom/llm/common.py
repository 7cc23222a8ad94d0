"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.session import materialize

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
ARROW_ROWS = 1000  # rows of an Arrow batch
ARROW_BYTES = 32 << 20  # and its bytes: long texts must fit a worker's memory
FILTER_BITS = 1 << 30  # largest id filter that is broadcast (128 MB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def named(**fields: Column) -> Column:
    """A struct with these field names, also inside a lambda."""
    return F.named_struct(*(x for name, value in fields.items() for x in (F.lit(name), value)))


def small_batches(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches small enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    return spark


SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``materialize``, with the shuffle files behind it dropped at once: the table is there to be read again, not they."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_END, None)
    conf.set(SHUFFLES_END, "true")
    try:
        return materialize(df, purpose)
    finally:
        conf.unset(SHUFFLES_END) if before is None else conf.set(SHUFFLES_END, before)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id written as text; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut a batch into runs of rows of about ``limit`` characters; null texts read as empty."""
    texts = [t or "" for t in batch.column(column).to_pylist()]
    start, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield batch.slice(start, k - start), texts[start:k]
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def byte_pieces(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """As ``pieces``, with texts as bytes and ``limit`` in bytes."""
    texts = [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]
    start, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield batch.slice(start, k - start), texts[start:k]
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def lists(arrays: list[np.ndarray], kind: pa.DataType | None = None) -> pa.ListArray:
    """One list per array."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind or pa.int64()))


def bit_filter(hashes: DataFrame, column: str, count: int, each: int = 16, least: int = 1 << 16) -> np.ndarray:
    """Bitmap over a column of 64-bit hashes: every value passes, few others do.

    ``each`` bits a value up to ``FILTER_BITS``; beyond that more strangers pass and
    the exact join that follows has more to drop.
    """
    bits = least
    while bits < min(each * count, FILTER_BITS):
        bits *= 2
    ids, slot = hashes, F.expr(f"{column} & {bits - 1}L")
    words = (
        ids.select(slot.alias("s"))
        .groupBy(F.expr("shiftright(s, 6)").alias("w"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("b"))
        .toPandas()
    )
    out = np.zeros(bits // 64, np.uint64)
    out[words["w"].to_numpy(np.int64)] = words["b"].to_numpy(np.int64).view(np.uint64)
    return out


def passes(filter_words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the filter."""
    slot = hashes.view(np.uint64) & np.uint64(64 * len(filter_words) - 1)
    word = filter_words[(slot >> np.uint64(6)).astype(np.int64)]
    return ((word >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
