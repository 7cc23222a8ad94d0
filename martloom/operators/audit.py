"""Row counts, samples and small guards."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.functions.calendar import zoneless


class NoNewRecords(RuntimeError):
    """The increment holds no purchase."""


class LimitReached(RuntimeError):
    """The registration cap on purchases is used up."""


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def audit_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row ``(table_name, n_rows)`` per table."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
            for name, df in tables.items()
        ]
    )


def require_rows(df: DataFrame) -> None:
    if df.isEmpty():
        raise NoNewRecords("no purchase was created since the last load")


def room_left(n_purchases, limit: int):
    """How many more purchases may be registered; of a number or a column."""
    return limit - n_purchases


def require_room(purchases: DataFrame, limit: int) -> None:
    """Stop registering once ``limit`` purchases are stored."""
    if room_left(purchases.count(), limit) <= 0:
        raise LimitReached(f"{limit} purchases are already registered")


def sample_rows(df: DataFrame, keys: Sequence[str], n: int, seed: str) -> DataFrame:
    """``n`` rows drawn by a seeded hash of their key: the same draw on every run."""
    text = F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(seed))
    return df.orderBy(F.md5(text.cast("binary")), *keys).limit(n)


def first_n(df: DataFrame, position: str, n: int) -> DataFrame:
    """Rows at positions 0 to n - 1 of a stored order."""
    return df.where(F.col(position) < n)


def created_after(df: DataFrame, low) -> DataFrame:
    """Rows loaded after ``low``, newest first."""
    return df.where(F.col("created_at") > zoneless(low)).orderBy(F.desc("created_at"))
