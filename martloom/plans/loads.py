"""Full and incremental load of the star schema into a table store."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.calendar import zoneless
from martloom.operators.audit import require_rows
from martloom.operators.merge import in_ranges, key_range, key_ranges, key_slices, last_per_key, once_per_key, rows_to_insert
from martloom.operators.quality import check, enforce, violations
from martloom.operators.store import TableStore
from martloom.plans import dims, facts
from martloom.schema import TARGETS, UPSERT_COLUMNS
from martloom.session import materialize, staging
from martloom.sources.tables import created_between, extract

MARK = T.StructType([T.StructField("high", T.TimestampNTZType())])
SNAPSHOT_MARK = "snapshot_mark"
DAY_MARK = T.StructType([T.StructField("date_id", T.LongType()), T.StructField("high", T.TimestampNTZType())])
SMALL = 16  # a batch of less than this part of a target is small beside it
# Facts of more purchases than SLICE are joined and written in up to SLICES slices, so that the shuffles of
# one slice lie on disk at a time.
SLICE, SLICES = 1_000_000, 8
DEFAULT_LOW = dt.datetime(2025, 4, 22, 3)  # midnight of the first load day in local time, as UTC

# Facts lie in one folder per order year or snapshot day, both functions of the fact's
# key, so that an insert-ignore reads only the folders its batch touches.
# Within a folder sales are sorted by purchase: ids grow with time, so a batch overlaps
# only the files of recent loads.
LAYOUT = {
    "fact_sales": {"partition_by": ("year",), "sort_by": ("purchase_id",)},
    "fact_inventory": {"partition_by": ("date_id",)},
}


def stored_schema(table: str) -> T.StructType:
    struct = TARGETS[table].struct
    return T.StructType([*struct, T.StructField("year", T.IntegerType())]) if table == "fact_sales" else struct


def read_target(store: TableStore, table: str) -> DataFrame:
    return store.read(table, stored_schema(table)).select(*TARGETS[table].names)


def read_targets(store: TableStore) -> dict[str, DataFrame]:
    return {t: read_target(store, t) for t in TARGETS}


def create_targets(store: TableStore) -> None:
    """Empty first versions with the declared schemas."""
    empty = {table: store.spark.createDataFrame([], stored_schema(table)) for table in TARGETS}
    with store.as_one():
        _together({table: partial(store.replace, table, df) for table, df in empty.items()})


def _together(jobs: Mapping[str, Callable[[], int | dict]]) -> dict:
    """Run writes that do not depend on each other side by side, so that small ones fill idle slots."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        started = {name: pool.submit(copy_context().run, job) for name, job in jobs.items()}
        return {name: job.result() for name, job in started.items()}


def _dimensions(driving: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "dim_customers": dims.dim_customers(driving["customers"]),
        "dim_items": dims.dim_items(driving["items"], tables["categories"]),
        "dim_sizes": dims.dim_sizes(driving["sizes"]),
        "dim_stores": dims.dim_stores(driving["stores"], tables["stores_addresses"], tables["addresses"]),
    }


def _sales(purchases: DataFrame, tables: Mapping[str, DataFrame], days: DataFrame, complete: bool) -> DataFrame:
    return facts.fact_sales(
        purchases,
        tables["purchases_status"],
        tables["purchases_items"],
        tables["prices"],
        days,
        complete=complete,
        keep_year=True,
    )


def _of_purchases(tables: Mapping[str, DataFrame], ranges: Sequence[tuple]) -> dict[str, DataFrame]:
    """The tables with lines and status of other purchases kept out by ranges of ids, exactly and by file statistics."""
    return {**tables} | {n: in_ranges(tables[n], "purchase_id", ranges) for n in ("purchases_items", "purchases_status")}


def _slices(purchases: DataFrame) -> list[DataFrame]:
    """The purchases, by ranges of their ids once they are many: facts are joined and written slice by slice, none left out."""
    cuts = key_slices(purchases, "id", SLICE, SLICES)
    return [in_ranges(purchases, "id", [cut]) for cut in cuts] if len(cuts) > 1 else [purchases]


def _replace_sales(store: TableStore, purchases: DataFrame, tables: Mapping[str, DataFrame], days: DataFrame) -> int:
    written, slices = 0, _slices(purchases)
    for k, some in enumerate(slices):
        own = _of_purchases(tables, [key_range(some, "id")]) if len(slices) > 1 else tables
        write = store.append if k else store.replace
        written += write("fact_sales", _sales(some, own, days, False), **LAYOUT["fact_sales"])
    return written


def save_mark(store: TableStore, high: dt.datetime, of: str = "load") -> None:
    store.replace(f"{of}_mark", store.spark.range(1).select(zoneless(high).alias("high")))


def last_mark(store: TableStore, of: str = "load") -> dt.datetime | None:
    """The mark of the star load, or of one table kept by a stream of its own."""
    row = store.read(f"{of}_mark", MARK).first()
    return row["high"] if row else None


def load_full(
    tables: Mapping[str, DataFrame],
    store: TableStore,
    snapshot_date: dt.date | None = None,
    high: dt.datetime | None = None,
    strict: bool = False,
    count_dropped: bool = False,
) -> dict[str, int]:
    """Write all seven targets anew, as one version; returns rows written per table.

    Readers see the old tables until all new ones are there. ``high`` keeps purchases up to a mark and stores it for the next increment.
    With ``strict`` nothing is written when a row breaks a declared rule. With ``count_dropped`` also returned:
    ``dropped_…``, lines its inner joins left out, as an increment does (a second pass over the lines).
    """
    snapshot_date = snapshot_date or dt.datetime.now(dt.UTC).date()
    purchases = tables["purchases"] if high is None else created_between(tables["purchases"], None, high)
    with staging(store.spark):
        days = materialize(dims.dim_time(purchases, snapshot_date), "days")
        built = {
            "dim_time": days,
            **_dimensions(tables, tables),
            "fact_sales": _sales(purchases, tables, days, False),
            "fact_inventory": facts.fact_inventory(tables["inventory"], facts.date_id_of(days, snapshot_date)),
        }
        if strict:
            built = {name: materialize(df, "checked") for name, df in built.items()}
            enforce(check(built, TARGETS))
        writes = {name: partial(store.replace, name, df, **LAYOUT.get(name, {})) for name, df in built.items()}
        if not strict:
            writes["fact_sales"] = partial(_replace_sales, store, purchases, tables, days)
        with store.as_one():
            written = _together(writes)
            if store.exists(SNAPSHOT_MARK):  # of days numbered before
                store.replace(SNAPSHOT_MARK, store.spark.createDataFrame([], DAY_MARK))
            if high is not None:
                save_mark(store, high)
        if count_dropped:
            written |= _dropped(purchases, tables, days)
    return written


def touched_purchases(
    delta: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], high: dt.datetime
) -> DataFrame:
    """Purchases of the slice, and older ones of which a line, a line's price or the status arrived only now.

    Lines are looked through only if prices arrived, and older purchases only if something of theirs did,
    there within the ranges of their ids.
    """
    own = delta["purchases"]
    arrived = delta["purchases_items"].select("purchase_id").union(delta["purchases_status"].select("purchase_id"))
    priced = materialize(delta["prices"].select("item_id", "size_id").distinct(), "priced")
    if not priced.isEmpty():
        arrived = arrived.union(tables["purchases_items"].join(priced, ["item_id", "size_id"], "left_semi").select("purchase_id"))
    late = materialize(arrived.distinct().join(own.select(F.col("id").alias("purchase_id")), "purchase_id", "left_anti").toDF("id"), "late")
    ranges = key_ranges(late, "id")
    if not ranges:
        return own
    older = created_between(in_ranges(tables["purchases"], "id", ranges), None, high)
    return own.unionByName(older.join(late, "id", "left_semi").select(*own.columns))


def apply_delta(
    delta: Mapping[str, DataFrame],
    tables: Mapping[str, DataFrame],
    store: TableStore,
    snapshot_date: dt.date,
    strict: bool = False,
    high: dt.datetime | None = None,
) -> dict[str, int]:
    """Bring a slice into the targets. The slice drives; lookups are read in full.

    Also returned: ``dropped_…``, how many of the purchases' lines had no date, status or price and
    wait for it; they are looked at again when it arrives in a slice of its own.
    Dimensions are upserted, new dates and new facts appended. Every step skips
    keys already there, so a slice that failed half-way or overlaps is simply run again.
    Pass purchases as a stored frame: it is read several times, and its real size
    decides whether lines and status are joined to it without being shuffled.
    With ``strict`` a row that breaks a declared rule stops its table from being written. With
    ``high``, the end of the slice, stock that a snapshot of the same day has seen is not read again.
    """
    purchases = delta["purchases"]
    days = read_target(store, "dim_time")
    added = dims.dim_time_additions(days, purchases, snapshot_date)
    written = {"dim_time": store.append("dim_time", added)}
    days = read_target(store, "dim_time")  # numbered and stored before any fact refers to it
    changes = _dimensions(delta, tables)
    written |= _together({name: partial(_upsert, store, name, df, strict) for name, df in changes.items()})
    date_id = facts.date_id_of(days, snapshot_date)
    # the large tables one after the other, so that the shuffles of both do not lie on disk at once
    sold: Counter[str] = Counter()
    slices = [purchases] if strict else _slices(purchases)  # rules are held before the first row is written
    for some in slices:
        with staging(store.spark):
            sold.update(_add_sales(store, some, tables, days, strict, len(slices) > 1))
    snapshot = _add_snapshot(store, tables["inventory"], date_id, strict, high)
    return {**written, "fact_inventory": snapshot, **sold}


def _dropped(purchases: DataFrame, tables: Mapping[str, DataFrame], days: DataFrame) -> dict[str, int]:
    lines, status = tables["purchases_items"], tables["purchases_status"]
    own = lines.join(purchases.select(F.col("id").alias("purchase_id")), "purchase_id", "left_semi")
    gone = facts.dropped_lines(purchases, status, own, tables["prices"], days).drop("no_purchase").first()
    return {f"dropped_{reason}": n for reason, n in gone.asDict().items()}


def _hold_to_rules(store: TableStore, name: str, batch: DataFrame) -> None:
    table = TARGETS[name]
    enforce(violations(batch, table, {r.parent: read_target(store, r.parent) for r in table.references}))


def _upsert(store: TableStore, name: str, changed: DataFrame, strict: bool) -> int:
    table = TARGETS[name]
    changed = materialize(changed if strict else last_per_key(changed, table.key), "dimension-batch")
    if changed.isEmpty():
        return 0
    if strict:
        _hold_to_rules(store, name, changed)
    return store.upsert(name, changed, table.key, UPSERT_COLUMNS[name], table.struct, unique=not strict)


def _add_sales(
    store: TableStore, purchases: DataFrame, tables: Mapping[str, DataFrame], days: DataFrame, strict: bool, sliced: bool = False
) -> dict[str, int]:
    tables = _of_purchases(tables, key_ranges(purchases, "id"))
    # the batch is looked at several times (its years, its keys, its rows, the lines it lacks something for): join it once
    key, given = TARGETS["fact_sales"].key, F.col("_status") & F.col("_price")
    lookups = (tables[n] for n in ("purchases_status", "purchases_items", "prices"))
    judged = materialize(facts.judged_sales(purchases, *lookups, days), "judged-sales")
    found = judged.agg(
        F.count_if(given).alias("rows"), F.count_if(F.col("_status").isNull()).alias("no_status"), F.count_if(F.col("_price").isNull()).alias("no_price")
    ).first()
    sales = judged.where(given).drop("_status", "_price")
    if strict:
        _hold_to_rules(store, "fact_sales", sales)
    else:
        sales = once_per_key(sales, key)
    stored = store.read("fact_sales", stored_schema("fact_sales"))
    small = not sliced and found["rows"] * SMALL < store.rows("fact_sales")
    fresh = rows_to_insert(stored, sales, key, within="year", ranged="purchase_id", small=small, unique=not strict)
    written = store.append("fact_sales", fresh, **LAYOUT["fact_sales"])
    # a line without date has failed the job before
    return {"fact_sales": written, "dropped_no_date": 0, "dropped_no_status": found["no_status"], "dropped_no_price": found["no_price"]}


def _add_snapshot(store: TableStore, inventory: DataFrame, date_id: int, strict: bool, high: dt.datetime | None = None) -> int:
    """Add the stock to the day's snapshot; after the day's first load only rows created since the last one are read."""
    marks = store.read(SNAPSHOT_MARK, DAY_MARK).where(F.col("date_id") == date_id) if high else None
    seen = marks.agg(F.max("high")).first()[0] if marks is not None else None
    snapshot = facts.fact_inventory(inventory if seen is None else created_between(inventory, seen, None), date_id)
    if strict:
        _hold_to_rules(store, "fact_inventory", snapshot)
    same_day = read_target(store, "fact_inventory").where(F.col("date_id") == date_id)
    # a whole stock is of the day's own size, what came since is small beside it
    fresh = rows_to_insert(same_day, snapshot, TARGETS["fact_inventory"].key, small=seen is not None)
    written = store.append("fact_inventory", fresh, **LAYOUT["fact_inventory"])
    if high is not None and (seen is None or high > seen):
        _mark_snapshot(store, date_id, high)
    return written


def _mark_snapshot(store: TableStore, date_id: int, high: dt.datetime) -> None:
    """Keep up to which creation time the day's snapshot has seen the stock; one row per day."""
    mark = store.spark.range(1).select(F.lit(date_id).cast("bigint").alias("date_id"), zoneless(high).alias("high"))
    store.append(SNAPSHOT_MARK, mark.coalesce(1))


def load_incremental(
    tables: Mapping[str, DataFrame],
    store: TableStore,
    high: dt.datetime,
    snapshot_date: dt.date | None = None,
    low: dt.datetime = DEFAULT_LOW,
    look_back: dt.timedelta = dt.timedelta(0),
    strict: bool = False,
) -> dict[str, int]:
    """Load rows created in ``(mark, high]`` and move the mark to ``high``; readers see all of it at once.

    ``low`` stands in while no mark is stored. Raises NoNewRecords on an empty slice.
    """
    low = (last_mark(store) or low) - look_back
    delta = extract(tables, low, high)
    with staging(store.spark):
        delta["purchases"] = materialize(delta["purchases"], "delta")
        require_rows(delta["purchases"])
        delta["purchases"] = materialize(touched_purchases(delta, tables, high), "touched")
        with store.as_one():
            written = apply_delta(delta, tables, store, snapshot_date or high.date(), strict, high)
            save_mark(store, high)
    return written
