"""Dense surrogate keys without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import materialize

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def dense_ids(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "id",
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Number rows ``start, start + 1, …`` in the order of ``order_by``, which must tell rows apart.

    Rows are range-partitioned and sorted, numbered inside each partition and
    written; a second step adds the count of all earlier partitions.  Only one
    row per partition is ever brought together.  Writing between the two steps
    keeps the numbers fixed when an executor is lost.
    """
    order_by = list(order_by)
    ranged = df.repartitionByRange(partitions, *order_by) if partitions else df.repartitionByRange(*order_by)
    marked = (
        ranged.sortWithinPartitions(*order_by)
        .withColumn("_mark", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_mark", _ROW_BITS))
    )
    kept = materialize(marked, "dense-ids")
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(  # one row per partition
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    local = F.col("_mark") - F.shiftleft(F.col("_part"), _ROW_BITS)
    return kept.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.lit(start) + F.col("_offset") + local).cast("bigint").alias(name)
    )


def pair_by_position(
    left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str]
) -> DataFrame:
    """Pair the n-th row of one ordered frame with the n-th of another; the shorter one ends it."""
    return dense_ids(left, left_order, "position").join(dense_ids(right, right_order, "position"), "position")


def max_key(df: DataFrame, column: str) -> int:
    """Largest key, 0 when the table is empty."""
    return df.agg(F.coalesce(F.max(column), F.lit(0)).cast("bigint")).first()[0]
