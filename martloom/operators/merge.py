"""Key-based merging of a batch into a target: insert-ignore, upsert, set difference."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.session import materialize, shuffles_end

RANGES = 32  # most key ranges pushed into one scan
CELLS = 4096  # cells of the bitmap the ranges are read off
_PLAIN = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)  # aggregated by hash, without a sort


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    # An aggregate, not a ranking window: copies of a hot key shrink to one row
    # per task before the shuffle.  All other columns break ties, so that a
    # retried task cannot choose differently.
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    if len(rest) == 1 and isinstance(df.schema[rest[0]].dataType, _PLAIN) and not set(order_by) - set(rest):
        value = pick(rest[0])
        if pick is F.min:  # nulls come first, as in a struct
            value = F.when(F.count(rest[0]) == F.count(F.lit(1)), value)
        return df.groupBy(*keys).agg(value.alias(rest[0])).select(*df.columns)
    order = list(order_by) + [c for c in rest if c not in order_by]
    # the row is its own order, so that it moves once
    return df.groupBy(*keys).agg(pick(F.struct(*order)).alias("_row")).select(*(c if c in keys else F.col(f"_row.{c}") for c in df.columns))


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    return _pick(df, keys, order_by, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    return _pick(df, keys, order_by, F.max)


def once_per_key(stored: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """``first_per_key`` of a stored frame: keys are counted first, by hash, and rows are only moved if a key comes twice."""
    with shuffles_end(stored.sparkSession):
        most = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).agg(F.max("_rows")).first()[0]
    return stored if (most or 0) < 2 else materialize(first_per_key(stored, keys, order_by), "first-rows")


def difference(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    keys = list(keys)
    return left.select(*keys).distinct().join(right.select(*keys), keys, "left_anti")


def rows_to_insert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    within: str | None = None,
    ranged: str | None = None,
    small: bool = True,
    unique: bool = False,
) -> DataFrame:
    """Rows of ``source`` whose key ``target`` lacks; the first row of a repeated key wins.

    ``within`` names a partition column of the target that is a function of the
    key and counts years or days; ``ranged`` an integer key column the target's files are
    sorted by.  The few partition values and the ranges of the batch are looked up
    first, so that other partitions and row groups are not read.  For a ``small``
    batch what is read is cut to the batch's keys before the anti join, so that
    under the broadcast threshold no row of the target is moved; a batch of the
    target's own size is compared with it directly.  A ``unique`` batch holds every
    key once already and is not grouped.
    """
    keys = list(keys)
    fresh = source if unique else first_per_key(source, keys, order_by)
    if within:
        # one row: the years or days of the batch, and its key range
        column = ranged or within
        touched, *bounds = source.agg(F.collect_set(within), F.min(column), F.max(column)).first()
        target = target.where(F.col(within).isin(touched))
        target = in_ranges(target, ranged, key_ranges(source, ranged, tuple(bounds))) if ranged else in_range(target, within, bounds)
    elif ranged:
        target = in_ranges(target, ranged, key_ranges(source, ranged))
    present = target.select(*keys)
    if small:
        present = present.join(fresh.select(*keys), keys, "left_semi")
    return fresh.join(present, keys, "left_anti").select(*source.columns)


def key_range(df: DataFrame, column: str) -> tuple:
    """Smallest and largest key, both null for an empty frame."""
    return tuple(df.agg(F.min(column), F.max(column)).first())


def in_range(df: DataFrame, column: str, bounds: tuple) -> DataFrame:
    """Rows whose key lies within ``bounds``: literals, so that scans skip by file statistics."""
    low, high = bounds
    return df.where(F.lit(False)) if low is None else df.where(F.col(column).between(low, high))


def key_ranges(df: DataFrame, column: str, bounds: tuple | None = None) -> list[tuple[int, int]]:
    """At most ``RANGES`` disjoint ranges that hold every integer key, few others between them.

    Keys become a bitmap of ``CELLS`` cells between smallest and largest key, found by a partial aggregate; the
    widest gaps between cells that hold one part the ranges. So a few keys far from the others don't
    stretch what is read over everything between.
    """
    low, high = bounds or key_range(df, column)
    if low is None:
        return []
    width = (high - low) // CELLS + 1
    cell = F.floor((F.col(column) - low) / width)
    cells = sorted(tuple(r)[1:] for r in df.groupBy(cell.alias("_cell")).agg(F.min(column), F.max(column)).collect() if r[0] is not None)
    apart = [k for k in range(1, len(cells)) if cells[k][0] - cells[k - 1][1] > 1]
    gaps = sorted(apart, key=lambda k: cells[k - 1][1] - cells[k][0])[: RANGES - 1]
    cuts = [0, *sorted(gaps), len(cells)]
    return [(cells[a][0], cells[b - 1][1]) for a, b in zip(cuts, cuts[1:], strict=False)]


def key_slices(df: DataFrame, column: str, size: int, most: int) -> list[tuple[int, int]]:
    """Disjoint ranges that hold every integer key and about equally many rows: one for up to ``size`` rows, then 2, 4, … up to ``most``, a power of two."""
    quantiles = F.percentile_approx(column, [k / most for k in range(1, most)])
    low, high, rows, cuts = df.agg(F.min(column), F.max(column), F.count(column), quantiles).first()
    if low is None:
        return []
    parts = min(most, 1 << (-(-rows // size) - 1).bit_length())
    ends = sorted({*cuts[most // parts - 1 :: most // parts], high}) if parts > 1 else [high]
    return list(zip([low, *(e + 1 for e in ends)], ends, strict=False))


def in_ranges(df: DataFrame, column: str, ranges: Sequence[tuple]) -> DataFrame:
    """Rows whose key lies in one of the ranges: literals, so that scans skip by file statistics."""
    return df.where(reduce(or_, (F.col(column).between(*r) for r in ranges)) if ranges else F.lit(False))


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), small: bool = True
) -> DataFrame:
    """The target after an insert that skips keys already there; ``small`` as in ``rows_to_insert``."""
    return target.unionByName(rows_to_insert(target, source, keys, order_by, small=small))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str],
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Insert new keys; on a known key replace ``update_columns`` only. The last source row wins.

    The source is thought of as the small side: updates are a left join from the
    target, which leaves a large target where it lies when the source is broadcast;
    new keys are added apart. Whether a row arrives is told by a flag, since a null
    value is not an absent row.
    """
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    incoming = last_per_key(source, keys, order_by).select(
        *keys, *(F.col(c).alias(f"_in_{c}") for c in rest), F.lit(True).alias("_arrives")
    )

    def merged(c: str) -> Column:
        if c not in update_columns:
            return F.col(c)
        return F.when(F.col("_arrives").isNotNull(), F.col(f"_in_{c}")).otherwise(F.col(c)).alias(c)

    updated = target.join(incoming, keys, "left").select(*(merged(c) for c in target.columns))
    known = target.select(*keys).join(incoming.select(*keys), keys, "left_semi")
    added = incoming.join(known, keys, "left_anti").select(
        *(F.col(c) if c in keys else F.col(f"_in_{c}").alias(c) for c in target.columns)
    )
    return updated.unionByName(added)


def merged(target: DataFrame, incoming: DataFrame, keys: Sequence[str], update_columns: Sequence[str]) -> DataFrame:
    """The target after an upsert of ``incoming`` (the target's columns, each key once), with ``_new`` for rows it adds.

    One full outer join: both sides are read and moved once, whatever their size.
    """
    keys = list(keys)
    rest = [c for c in target.columns if c not in keys]
    arrives, known = F.col("_arrives").isNotNull(), F.col("_known").isNotNull()
    both = target.withColumn("_known", F.lit(True)).join(
        incoming.select(*keys, *(F.col(c).alias(f"_in_{c}") for c in rest), F.lit(True).alias("_arrives")), keys, "full_outer"
    )
    value = {c: F.when(arrives & (F.lit(c in update_columns) | ~known), F.col(f"_in_{c}")).otherwise(F.col(c)) for c in rest}
    return both.select(*(value[c].alias(c) if c in value else F.col(c) for c in target.columns), (~known).alias("_new"))
