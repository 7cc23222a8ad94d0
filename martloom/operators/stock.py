"""Stock check, sequential allocation and stock movements.

Allocation takes lines in order and accepts a line while the stock left for its
key covers it; a line that does not fit is skipped and leaves the stock alone.
A running sum cannot express that, so each key is a fold over its ordered lines.
A key may hold a large share of all lines.  Such keys are cut into ordered
chunks of bounded size; the opening stock of every chunk is found from chunk
totals, after which all chunks are folded in parallel like small keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import materialize

MAX_GROUP = 50_000  # most lines folded as one group


def check_stock(lines: DataFrame, inventory: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Flag each line ``in_stock``; a key without stock row has none."""
    held = inventory.select(*keys, F.col("quantity").alias("_held"))
    return lines.join(held, list(keys), "left").select(
        *lines.columns, F.coalesce(F.col("_held") >= F.col("quantity"), F.lit(False)).alias("in_stock")
    )


def apply_decrements(
    inventory: DataFrame, lines: DataFrame, keys: Sequence[str], quantity: str = "quantity"
) -> DataFrame:
    """Inventory after the accepted ``lines`` left it; lines are summed per key before they meet it."""
    keys = list(keys)
    taken = lines.groupBy(*keys).agg(F.sum(quantity).alias("_taken"))
    left = (F.col("quantity") - F.coalesce(F.col("_taken"), F.lit(0))).cast(inventory.schema["quantity"].dataType)
    return inventory.join(taken, keys, "left").withColumn("quantity", left).select(*inventory.columns)


# --- the fold over one ordered group ------------------------------------------


def _fold(lines: Column, opening: Column) -> Column:
    """Fold an ordered array of (order…, qty) to ``(left, n, bars)``.

    The stock left never grows, so once a quantity has been refused every line of
    that size or more behind it is refused too.  ``bars`` records only refusals of
    a new smallest quantity, hence at most one entry per distinct quantity.
    """
    start = F.struct(
        opening.cast("bigint").alias("left"),
        F.lit(0).alias("n"),
        F.array().cast("array<struct<at:int,qty:bigint>>").alias("bars"),
    )

    def step(acc: Column, line: Column) -> Column:
        qty = line["qty"]
        fits = F.coalesce(qty <= acc["left"], F.lit(False))
        lowest = F.try_element_at(acc["bars"], F.lit(-1))["qty"]
        known = fits | qty.isNull() | F.coalesce(lowest <= qty, F.lit(False))
        bar = F.array(F.struct(acc["n"].alias("at"), qty.alias("qty")))
        return F.struct(
            F.when(fits, acc["left"] - qty).otherwise(acc["left"]).alias("left"),
            (acc["n"] + 1).alias("n"),
            F.when(known, acc["bars"]).otherwise(F.concat(acc["bars"], bar)).alias("bars"),
        )

    return F.aggregate(lines, start, step)


def _fold_groups(lines: DataFrame, group: Sequence[str], order_by: Sequence[str], quantity: str) -> DataFrame:
    """One row per group: its ordered lines, opening stock and fold result."""
    rest = [c for c in lines.columns if c not in (*group, *order_by, "_open")]
    line = F.struct(*order_by, F.col(quantity).cast("bigint").alias("qty"), *rest)
    return (
        lines.groupBy(*group)
        .agg(F.array_sort(F.collect_list(line)).alias("_lines"), F.max("_open").alias("_open"))
        .withColumn("_end", _fold(F.col("_lines"), F.coalesce("_open", F.lit(0))))
    )


def _judge(folded: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    def verdict(line: Column, i: Column) -> Column:
        refused = F.exists(F.col("_end.bars"), lambda b: (b["at"] <= i) & (b["qty"] <= line["qty"]))
        return F.struct(line.alias("line"), (line["qty"].isNotNull() & ~refused).alias("accepted"))

    judged = folded.select(*keys, F.explode(F.transform("_lines", verdict)).alias("_v"))
    return judged.select(
        *(F.col(c) if c in keys else F.col(f"_v.line.{c}") for c in columns), F.col("_v.accepted")
    )


# --- hot keys -----------------------------------------------------------------


def _chunk_openings(
    chunked: DataFrame, opening: DataFrame, keys: Sequence[str], order_by: Sequence[str], quantity: str
) -> DataFrame:
    """Opening stock per (key, chunk).

    Each round adds up, per chunk, the lines no larger than the stock left.  All
    chunks before the first one whose running total passes that stock open with
    the stock minus the total so far, and take every such line.  That first chunk
    alone is folded to learn what it leaves.  A refusal retires a quantity for good,
    so there are at most as many rounds as distinct quantities (or chunks).
    """
    keys = list(keys)
    totals = materialize(
        chunked.groupBy(*keys, "_chunk", F.col(quantity).cast("bigint").alias("_qty")).agg(
            F.sum(F.col(quantity).cast("bigint")).alias("_sum")
        ),
        "chunk-totals",
    )
    state = materialize(
        opening.select(*keys, F.col("_open").alias("_left"), F.lit(-1).cast("bigint").alias("_after")), "stock-left"
    )
    in_key = Window.partitionBy(*keys)
    so_far = in_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    openings = None
    while True:
        live = (
            totals.join(state, keys)
            .where((F.col("_chunk") > F.col("_after")) & (F.col("_qty") <= F.col("_left")))
            .groupBy(*keys, "_chunk", "_left")
            .agg(F.sum("_sum").alias("_sum"))
            .withColumn("_total", F.sum("_sum").over(so_far))
            .withColumn("_pivot", F.min(F.when(F.col("_total") > F.col("_left"), F.col("_chunk"))).over(in_key))
        )
        settled = materialize(
            live.where(F.col("_pivot").isNull() | (F.col("_chunk") <= F.col("_pivot"))).select(
                *keys,
                "_chunk",
                (F.col("_left") - F.col("_total") + F.col("_sum")).alias("_open"),
                (F.col("_chunk") == F.coalesce("_pivot", F.lit(-1))).alias("_is_pivot"),
            ),
            "chunk-openings",
        )
        opened = settled.select(*keys, "_chunk", "_open")
        openings = opened if openings is None else openings.unionByName(opened)
        pivots = settled.where("_is_pivot").drop("_is_pivot")
        if pivots.isEmpty():
            return openings
        folded = _fold_groups(
            chunked.select(*keys, "_chunk", *order_by, *([] if quantity in order_by else [quantity])).join(
                pivots, [*keys, "_chunk"]
            ),
            [*keys, "_chunk"],
            order_by,
            quantity,
        )
        state = materialize(
            folded.select(*keys, F.col("_end.left").alias("_left"), F.col("_chunk").alias("_after")).where(
                F.col("_left") > 0
            ),
            "stock-left",
        )


def _allocate_hot(
    lines: DataFrame,
    opening: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    quantity: str,
    max_group: int,
) -> DataFrame:
    # Range partitions over (key, order) are pieces of one key's sequence; every run of
    # max_group rows in a piece is a chunk.  Written down, so that a chunk is the same
    # set of lines in every round, also after an executor is lost.
    # Lines that agree in order_by follow each other by quantity and the other columns, as in the fold.
    mark = F.monotonically_increasing_id()
    rest = [c for c in lines.columns if c not in (*keys, *order_by)]
    total_order = [*keys, *order_by, F.col(quantity).cast("bigint"), *rest]
    piece = F.shiftright("_chunk", 33)
    place = F.col("_chunk") - F.shiftleft(piece, 33)
    chunked = materialize(
        lines.repartitionByRange(*total_order)
        .sortWithinPartitions(*total_order)
        .withColumn("_chunk", mark)
        .withColumn("_chunk", F.shiftleft(piece, 33) + F.floor(place / max_group)),
        "chunks",
    )
    openings = _chunk_openings(chunked, opening, keys, order_by, quantity)
    group = [*keys, "_chunk"]
    folded = _fold_groups(chunked.join(openings, group, "left"), group, order_by, quantity)
    return _judge(folded, keys, lines.columns)


def allocate(
    lines: DataFrame,
    stock: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    quantity: str = "quantity",
    held: str = "quantity",
    max_group: int = MAX_GROUP,
) -> DataFrame:
    """``lines`` with ``accepted``: taken in ``order_by`` while the stock of their key lasts.

    Lines of a key that agree in ``order_by`` are taken by quantity, then by their other
    columns. ``stock`` has one row per key and a missing row means no stock.  A quantity
    that is not positive fails the job; a null one is refused.
    """
    keys, order_by = list(keys), list(order_by)
    q = F.col(quantity)
    positive = F.when(q <= 0, F.raise_error(F.lit("a quantity is not positive"))).otherwise(q)
    lines = materialize(lines.withColumn(quantity, positive.cast(lines.schema[quantity].dataType)), "lines")  # read two or three times
    opening = stock.select(*keys, F.col(held).cast("bigint").alias("_open"))
    sizes = lines.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(sizes.where(F.col("_n") > max_group), "hot-keys")
    if hot.isEmpty():
        return _allocate_cold(lines, opening, keys, order_by, quantity)

    hot_keys = hot.select(*keys)  # stored, so its real size decides how it is joined
    same = reduce(and_, (lines[k].eqNullSafe(hot_keys[k]) for k in keys))  # a null key can be hot, too
    cold = _allocate_cold(lines.join(hot_keys, same, "left_anti"), opening, keys, order_by, quantity)
    hot_lines = lines.join(hot_keys, same, "left_semi")
    hot_stock = opening.join(hot_keys, keys, "left_semi")
    return cold.unionByName(
        _allocate_hot(hot_lines, hot_stock, keys, order_by, quantity, max_group)
    )


def _allocate_cold(
    lines: DataFrame, opening: DataFrame, keys: Sequence[str], order_by: Sequence[str], quantity: str
) -> DataFrame:
    # Lines are gathered per key first and meet the stock as one row per key: one
    # shuffle of the lines, and both sides of the join hold each key once.
    rest = [c for c in lines.columns if c not in (*keys, *order_by)]
    line = F.struct(*order_by, F.col(quantity).cast("bigint").alias("qty"), *rest)
    folded = (
        lines.groupBy(*keys)
        .agg(F.array_sort(F.collect_list(line)).alias("_lines"))
        .join(opening, list(keys), "left")
        .withColumn("_end", _fold(F.col("_lines"), F.coalesce("_open", F.lit(0))))
    )
    return _judge(folded, keys, lines.columns)


def rejected_lines(allocated: DataFrame) -> DataFrame:
    return allocated.where(~F.col("accepted")).drop("accepted")


def orders_without_lines(allocated: DataFrame, order_key: str) -> DataFrame:
    """Orders of which no line was accepted; one partial aggregate, no self join."""
    return (
        allocated.groupBy(order_key)
        .agg(F.bool_or("accepted").alias("_any"))
        .where(~F.col("_any"))
        .select(order_key)
    )
