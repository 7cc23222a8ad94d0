"""The loads as Structured Streaming jobs; every micro-batch may be replayed safely."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martloom.operators.merge import first_per_key, key_ranges, rows_to_insert
from martloom.operators.stock import MAX_GROUP, allocate, apply_decrements
from martloom.operators.store import TableStore
from martloom.plans.loads import apply_delta, create_targets, last_mark, save_mark, touched_purchases
from martloom.schema import SLICED_SOURCES
from martloom.session import materialize, staging
from martloom.sources.tables import created_between

LEDGER, SUMMED = "moved_sum", "moved_summed"  # movements of finished batches, and the last batch of each run among them
SUMMED_SCHEMA = T.StructType([T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())])
COMPACT_EVERY = 8


def _start(
    stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, every: str | None
) -> StreamingQuery:
    """Drain what is there and stop, or go on ``every`` interval, such as "1 hour"."""
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def stream_insert_ignore(
    stream: DataFrame,
    root: str,
    table: str,
    keys: Sequence[str],
    mark: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Append rows whose key the table lacks, and keep the largest ``mark`` value loaded, table by table.

    Every batch becomes a folder with an index of its keys (ranges of the first key column, if that is an integer), and
    only folders that may hold a key of the batch are read.
    """
    schema = stream.schema
    index = keys[0] if isinstance(schema[keys[0]].dataType, T.IntegralType) else None

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        store = TableStore(batch.sparkSession, root)
        with staging(batch.sparkSession):  # grouped and stored once: its keys and rows are read from there
            high = batch.agg(F.max(mark)).first()[0]
            fresh = materialize(first_per_key(batch, keys, [mark]), "stream-batch")
            target = store.read_near(table, schema, index, key_ranges(fresh, index)) if index else store.read(table, schema)
            with store.as_one():
                store.append(table, rows_to_insert(target, fresh, keys, unique=True), index=index)
                known = last_mark(store, table)
                if known is None or high > known:
                    save_mark(store, high, table)

    return _start(stream, step, checkpoint, every)


def stream_sales(
    purchases: DataFrame,
    tables: Mapping[str, DataFrame],
    root: str,
    checkpoint: str,
    snapshot_date: dt.date | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """The incremental star load, driven by a stream of purchases.

    Dimension rows created since the stored mark come along with each batch. Without
    ``snapshot_date`` the stock is taken under the day the batch runs.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        store = TableStore(batch.sparkSession, root)
        if not store.exists("fact_sales"):
            create_targets(store)
        with staging(batch.sparkSession):
            batch = materialize(batch, "batch")
            low, high = last_mark(store), batch.agg(F.max("created_at")).first()[0]
            if low is not None:
                high = max(low, high)
            delta = {n: created_between(tables[n], low, high) for n in SLICED_SOURCES if n in tables}
            delta["purchases"] = batch
            if low is not None:  # nothing older is loaded before the first mark
                delta["purchases"] = materialize(touched_purchases(delta, tables, high), "touched")
            with store.as_one():
                apply_delta(delta, tables, store, snapshot_date or dt.datetime.now(dt.UTC).date(), high=high)
                save_mark(store, high)

    return _start(purchases, step, checkpoint, every)


def open_stock(store: TableStore, inventory: DataFrame) -> None:
    """The stock before any batch; later movements are kept beside it."""
    store.replace("stock", inventory)


def _children(spark: SparkSession, path: str, name: str) -> list[str]:
    """Values of the folders ``name=…`` below ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where) or []
    return sorted(s.getPath().getName().removeprefix(f"{name}=") for s in found)


def _folders(spark: SparkSession, root: str, table: str, schema: T.StructType, folders: Sequence[str] | None = None) -> DataFrame:
    """What batches wrote below ``root/table``, with ``run`` and ``batch``: in all folders, or in those named."""
    known = T.StructType([*schema, T.StructField("run", T.StringType()), T.StructField("batch", T.LongType())])
    if folders is None:
        folders = [f"run={run}" for run in _children(spark, f"{root}/{table}", "run")]
    if not folders:
        return spark.createDataFrame([], known)
    return spark.read.schema(known).option("basePath", f"{root}/{table}").parquet(*(f"{root}/{table}/{f}" for f in folders))


def _movements(stock_schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    return T.StructType([*(stock_schema[k] for k in keys), T.StructField("quantity", T.LongType())])


def _open_batches(spark: SparkSession, root: str, summed: Mapping[str, int]) -> dict[str, list[int]]:
    """Batches of each run whose movements are not in the ledger's sum yet."""
    runs = _children(spark, f"{root}/moved", "run")
    batches = {run: sorted(map(int, _children(spark, f"{root}/moved/run={run}", "batch"))) for run in runs}
    return {run: [b for b in some if b > summed.get(run, -1)] for run, some in batches.items()}


def _moved(spark: SparkSession, root: str, stock_schema: T.StructType, keys: Sequence[str], leave_out: tuple[str, int] | None = None) -> DataFrame:
    """What left the stock of each key: the ledger's sum, and the batches behind it but for ``leave_out`` (run, batch)."""
    schema, store = _movements(stock_schema, keys), TableStore(spark, root)
    summed = {r["run"]: r["batch"] for r in store.read(SUMMED, SUMMED_SCHEMA).collect()}  # one row a run
    later = [f"run={run}/batch={b}" for run, some in _open_batches(spark, root, summed).items() for b in some if (run, b) != leave_out]
    return store.read(LEDGER, schema).unionByName(_folders(spark, root, "moved", schema, later).select(*schema.names))


def compact_ledger(spark: SparkSession, root: str, stock_schema: T.StructType, keys: Sequence[str], own: tuple[str, int] | None = None) -> int:
    """Add the movements of finished batches to the ledger's sum, in one version; returns how many batches went in.

    A run's last batch may still be replayed and stays out; of the run ``own`` (run, batch now at work) all before it go in.
    """
    schema, store = _movements(stock_schema, keys), TableStore(spark, root, keep=2)
    summed = {r["run"]: r["batch"] for r in store.read(SUMMED, SUMMED_SCHEMA).collect()}
    done = {run: [b for b in some if b < (own[1] if own and run == own[0] else some[-1])] for run, some in _open_batches(spark, root, summed).items() if some}
    folders = [f"run={run}/batch={b}" for run, some in done.items() for b in some]
    if folders:
        added = store.read(LEDGER, schema).unionByName(_folders(spark, root, "moved", schema, folders).select(*schema.names))
        marks = {**summed, **{run: some[-1] for run, some in done.items() if some}}
        with store.as_one():
            store.replace(LEDGER, added.groupBy(*keys).agg(F.sum("quantity").cast("long").alias("quantity")))
            store.replace(SUMMED, spark.createDataFrame(sorted(marks.items()), SUMMED_SCHEMA).coalesce(1))
    return len(folders)


def stock_left(spark: SparkSession, root: str, stock_schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The opening stock less what the batches so far took."""
    opening = TableStore(spark, root).read("stock", stock_schema)
    return apply_decrements(opening, _moved(spark, root, stock_schema, keys), keys)


def stream_allocate(
    lines: DataFrame,
    root: str,
    stock_schema: T.StructType,
    keys: Sequence[str],
    order_by: Sequence[str],
    checkpoint: str,
    max_group: int = MAX_GROUP,
    every: str | None = None,
) -> StreamingQuery:
    """Allocate a stream of order lines; the stock left is carried to the next batch.

    Stock is a stored table rather than per-key stream state, so that the lines of
    a hot key are spread over tasks as in a batch. It is never rewritten: each batch
    writes its verdicts, and what it took of each key, to folders of its own, named by
    checkpoint and batch, and sees the opening stock less all other batches' movements. A
    replayed batch writes the same again. Under a new checkpoint, lines that an earlier one
    judged are known by ``keys`` and ``order_by`` and passed over; all others are judged. Every
    ``COMPACT_EVERY`` batches the movements of finished batches go into one sum (``compact_ledger``), so that
    what a batch reads does not grow with the batches before it.
    """
    keys, order_by = list(keys), list(order_by)
    run = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    line_schema = T.StructType([lines.schema[c] for c in dict.fromkeys([*keys, *order_by])])

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        own = f"run={run}/batch={batch_id}"
        opening = TableStore(spark, root).read("stock", stock_schema)
        others = [f"run={r}" for r in _children(spark, f"{root}/allocated", "run") if r != run]
        if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
            compact_ledger(spark, root, stock_schema, keys, (run, batch_id))
        with staging(spark):
            moved = materialize(_moved(spark, root, stock_schema, keys, (run, batch_id)), "moved")
            known = _folders(spark, root, "allocated", line_schema, others).select(*line_schema.names)
            same = reduce(and_, (batch[c].eqNullSafe(known[c]) for c in line_schema.names))
            judged = allocate(
                batch.join(known, same, "left_anti"), apply_decrements(opening, moved, keys), keys, order_by, max_group=max_group
            )
            judged.write.mode("overwrite").parquet(f"{root}/allocated/{own}")
        taken = spark.read.schema(judged.schema).parquet(f"{root}/allocated/{own}").where("accepted")
        sums = taken.groupBy(*keys).agg(F.sum("quantity").cast("long").alias("quantity"))
        sums.write.mode("overwrite").parquet(f"{root}/moved/{own}")

    return _start(lines, step, checkpoint, every)


def read_allocated(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Verdicts of all batches so far, with the run and batch that gave them."""
    return _folders(spark, root, "allocated", T.StructType([*schema, T.StructField("accepted", T.BooleanType())]))
