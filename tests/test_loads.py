import datetime as dt
import threading
import time

import pytest
from conftest import D, NEW, OLD, SF_DIR, rows
from pyspark.sql import functions as F

from martloom.operators.audit import LimitReached, NoNewRecords, require_room
from martloom.operators.quality import RuleViolation
from martloom.operators.merge import key_slices, once_per_key
from martloom.operators.store import TableStore
from martloom.plans import dims, facts, loads
from martloom.schema import TARGETS
from martloom.session import SHUFFLES_END, materialize, prepare, shuffles_end, work_path
from martloom.sources import testdata
from martloom.sources.tables import extract
from registry.base import Inputs

MARK, HIGH = dt.datetime(2025, 4, 22), dt.datetime(2025, 4, 24)
DAY1, DAY2 = D(2025, 4, 22), D(2025, 4, 24)


def new_store(spark):
    return TableStore(spark, work_path(spark, "toy"))


def test_full_load_golden(spark, toy):
    store = new_store(spark)
    written = loads.load_full(toy, store, DAY1)
    got = loads.read_targets(store)
    assert rows(got["dim_time"]) == [
        (1, D(2021, 1, 4), 4, 1, 1, 2021, False),
        (2, D(2025, 4, 18), 18, 4, 2, 2025, False),
        (3, D(2025, 4, 19), 19, 4, 2, 2025, True),
        (4, D(2025, 4, 20), 20, 4, 2, 2025, True),
        (5, DAY1, 22, 4, 2, 2025, False),
    ]
    assert rows(got["dim_items"]) == [(1, "Tablet", "Eletronicos"), (2, "Romance", "Livros"), (3, "Webcam", "Eletronicos")]
    assert rows(got["dim_sizes"]) == [(1, "Unico"), (2, "P")]
    assert rows(got["dim_customers"]) == [
        (1, "João da Silva", "joo.silva@example.com", OLD),
        (2, "Ana", "ana@example.com", NEW),
    ]
    assert rows(got["dim_stores"]) == [
        (1, "Loja Azul", "Curitiba", "PR", "Sul", "80000"),  # the younger of two addresses
        (2, "Ponto Certo", None, "SP", "Sudeste", "01000000"),
        (3, "Sem Lugar", None, None, None, None),
    ]
    assert rows(got["fact_sales"]) == [
        (1, 1, 1, 1, 1, 2, "Sent", 200.2, 2),
        (1, 2, 1, 1, 1, 2, "Sent", 20.0, 1),
        (2, 1, 1, None, 2, 3, "Canceled", 100.1, 1),
        (4, 3, 1, 2, 2, 4, "Pending", 55.55 * 3, 3),
        (5, 2, 1, 1, 1, 1, "Delivered", 80.0, 4),
        (6, 1, 1, None, 1, 2, "Sent", 100.1, 1),
    ]
    assert rows(got["fact_inventory"]) == [(1, 1, 1, 5, 10), (2, 1, 2, 5, 0), (9, 9, 1, 5, 7)]
    assert written["fact_sales"] == 6 and written["dim_time"] == 5
    for name, df in got.items():
        assert [f.dataType for f in df.schema] == [f.dataType for f in TARGETS[name].struct]


def test_dropped_lines(spark, toy):
    days = dims.dim_time(toy["purchases"])
    gone = facts.dropped_lines(toy["purchases"], toy["purchases_status"], toy["purchases_items"], toy["prices"], days)
    assert tuple(gone.first()) == (0, 0, 1, 1)


def dated(store):
    days = loads.read_target(store, "dim_time").select("date_id", "date")
    return rows(loads.read_target(store, "fact_sales").join(days, "date_id").drop("date_id"))


def test_full_then_increment_equals_full(spark, toy):
    whole, parts = new_store(spark), new_store(spark)
    loads.load_full(toy, whole, DAY2)
    loads.load_full(toy, parts, DAY1, high=MARK)
    assert loads.last_mark(parts) == MARK
    assert loads.read_target(parts, "fact_sales").count() == 3
    written = loads.load_incremental(toy, parts, HIGH, DAY2)
    assert written["fact_sales"] == 3 and loads.last_mark(parts) == HIGH
    assert dated(parts) == dated(whole)
    # numbering went on after the first load: late date, Sunday, snapshot day
    assert rows(loads.read_target(parts, "dim_time"), "date_id", "date") == [
        (1, D(2025, 4, 18)),
        (2, D(2025, 4, 19)),
        (3, DAY1),
        (4, D(2021, 1, 4)),
        (5, D(2025, 4, 20)),
        (6, DAY2),
    ]
    assert loads.read_target(parts, "fact_inventory").count() == 6  # one snapshot per day


def test_reload_changes_nothing(spark, toy):
    store = new_store(spark)
    loads.load_full(toy, store, DAY1, high=MARK)
    loads.load_incremental(toy, store, HIGH, DAY2)
    before = {t: rows(df) for t, df in loads.read_targets(store).items()}
    written = loads.load_incremental(toy, store, HIGH, DAY2, look_back=dt.timedelta(days=9))
    assert written["fact_sales"] == 0 and written["fact_inventory"] == 0 and written["dim_time"] == 0
    assert {t: rows(df) for t, df in loads.read_targets(store).items()} == before


def test_increment_upserts_changed_dimension_rows(spark, toy):
    store = new_store(spark)
    loads.load_full(toy, store, DAY1, high=MARK)
    renamed = toy["customers"].withColumn("full_name", F.upper("full_name"))
    loads.load_incremental({**toy, "customers": renamed}, store, HIGH, DAY2)
    names = rows(loads.read_target(store, "dim_customers"), "customer_id", "full_name")
    assert names == [(1, "João da Silva"), (2, "ANA")]  # only customer 2 is in the slice


def test_empty_slice_is_an_error(spark, toy):
    store = new_store(spark)
    loads.load_full(toy, store, DAY1, high=HIGH)
    with pytest.raises(NoNewRecords):
        loads.load_incremental(toy, store, dt.datetime(2025, 5, 1))
    assert loads.last_mark(store) == HIGH


def test_slice_bounds(spark, toy):
    assert extract(toy) == toy
    plan = extract(toy, OLD)["purchases"]._jdf.queryExecution().optimizedPlan().toString()
    assert "created_at#" in plan and "cast(created_at" not in plan
    assert extract(toy, OLD, NEW)["purchases"].count() == 3  # low is open, high is closed
    assert extract(toy, OLD, OLD)["purchases"].count() == 0
    assert len(extract(toy, OLD)) == 13


def test_missing_date_fails_the_checked_join(spark, toy):
    days = dims.dim_time(toy["purchases"].where("id < 3"))
    with pytest.raises(Exception, match="no date_id for order date"):
        facts.dated_purchases(toy["purchases"], days, complete=True).collect()
    with pytest.raises(LookupError):
        facts.date_id_of(days, DAY2)


def test_empty_targets(spark):
    store = new_store(spark)
    loads.create_targets(store)
    assert all(df.count() == 0 for df in loads.read_targets(store).values())


def clean(toy):
    """The toy source without the rows that break a rule of the targets."""
    return {
        **toy,
        "stores": toy["stores"].where("id < 3"),
        "inventory": toy["inventory"].where("item_id < 9"),
    }


def test_strict_loads(spark, toy):
    store = new_store(spark)
    with pytest.raises(RuleViolation, match="dim_stores not_null:state 3"):
        loads.load_full({**toy, "inventory": toy["inventory"].where("item_id < 9")}, store, DAY1, strict=True)
    assert not store.exists("fact_sales") and not store.exists("dim_time")  # nothing was written
    loads.load_full(clean(toy), store, DAY1, high=MARK, strict=True)
    orphan = toy["purchases"].withColumn("store_id", F.when(F.col("id") == 6, 77).otherwise(F.col("store_id")))
    with pytest.raises(RuleViolation, match="fact_sales foreign_key:store_id->dim_stores 77"):
        loads.load_incremental({**clean(toy), "purchases": orphan}, store, HIGH, DAY2, strict=True)
    assert loads.last_mark(store) == MARK and loads.read_target(store, "fact_sales").count() == 3
    loads.load_incremental(clean(toy), store, HIGH, DAY2, strict=True)
    assert loads.read_target(store, "fact_sales").count() == 6


def test_limit(spark):
    require_room(spark.range(499), 500)
    with pytest.raises(LimitReached):
        require_room(spark.range(500), 500)


def test_default_days_and_stamps(spark, toy):
    from martloom.plans.registration import _stamp

    store, today = new_store(spark), dt.datetime.now(dt.UTC).date()
    loads.load_full(toy, store)
    assert facts.date_id_of(loads.read_target(store, "dim_time"), today) == 5  # after the four order dates
    for zone in ("America/Sao_Paulo", "UTC"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        now = spark.range(1).select(_stamp(None).alias("s")).first()["s"]
        assert abs(now - dt.datetime.now(dt.UTC).replace(tzinfo=None)) < dt.timedelta(minutes=5)


def test_increment_without_a_single_fact(spark, toy):
    store = new_store(spark)
    loads.load_full(toy, store, DAY1, high=MARK)
    none = {**toy, "purchases_status": toy["purchases_status"].where("purchase_id < 4")}
    written = loads.load_incremental(none, store, HIGH, DAY2)
    assert written["fact_sales"] == 0 and written["dim_time"] == 3


def test_increment_into_an_empty_store(spark, toy):
    store = new_store(spark)
    written = loads.load_incremental(toy, store, HIGH, DAY2, low=dt.datetime(2025, 1, 1))
    assert written["fact_sales"] == 6 and written["dim_customers"] == 2
    assert loads.read_target(store, "dim_time").count() == 5


def test_null_order_date_fails_full_and_incremental_loads(spark, toy):
    broken = {**toy, "purchases": toy["purchases"].withColumn("order_date", F.when(F.col("id") != 4, F.col("order_date")))}
    store = TableStore(spark, work_path(spark, "null-date"))
    with pytest.raises(Exception, match="no valid order date"):
        loads.load_full(broken, store, D(2025, 4, 24))
    store = TableStore(spark, work_path(spark, "null-date"))
    loads.load_full(toy, store, D(2025, 4, 24), high=OLD)
    with pytest.raises(Exception, match="no valid order date"):
        loads.load_incremental(broken, store, high=dt.datetime(2025, 4, 24))


def test_late_line_and_status_reach_the_fact(spark, toy):
    # purchase 3 has no status at first, purchase 1 gets a further line later
    parts, whole = (TableStore(spark, work_path(spark, name)) for name in ("late-parts", "late-whole"))
    status = toy["purchases_status"].unionByName(spark.createDataFrame([(3, "Sent", NEW)], toy["purchases_status"].schema))
    lines = toy["purchases_items"].withColumn("created_at", F.when(F.expr("purchase_id = 1 and item_id = 2"), F.lit(NEW).cast("timestamp_ntz")).otherwise(F.col("created_at")))
    later = {**toy, "purchases_status": status, "purchases_items": lines}
    first = {**later, "purchases_status": status.where(F.col("created_at") <= F.lit(OLD).cast("timestamp_ntz")), "purchases_items": lines.where(F.col("created_at") <= F.lit(OLD).cast("timestamp_ntz"))}
    loads.load_full(first, parts, D(2025, 4, 24), high=OLD)
    written = loads.load_incremental(later, parts, high=NEW, snapshot_date=D(2025, 4, 24))
    loads.load_full(later, whole, D(2025, 4, 24))
    dated = lambda s: loads.read_target(s, "fact_sales").join(loads.read_target(s, "dim_time").select("date_id", "date"), "date_id").drop("date_id")
    assert rows(dated(parts)) == rows(dated(whole))
    assert {k: v for k, v in written.items() if k.startswith("dropped_")} == {"dropped_no_date": 0, "dropped_no_status": 0, "dropped_no_price": 0}


def test_late_price_reaches_the_fact(spark, toy):
    # item 1 has no price at first; its lines belong to purchases of the first load
    parts, whole = (TableStore(spark, work_path(spark, name)) for name in ("price-parts", "price-whole"))
    prices = toy["prices"].withColumn("created_at", F.when(F.col("item_id") == 1, F.lit(NEW).cast("timestamp_ntz")).otherwise(F.col("created_at")))
    later = {**toy, "prices": prices}
    loads.load_full({**later, "prices": prices.where(F.col("created_at") <= F.lit(OLD).cast("timestamp_ntz"))}, parts, D(2025, 4, 24), high=OLD)
    first = loads.read_target(parts, "fact_sales").count()
    loads.load_incremental(later, parts, high=NEW, snapshot_date=D(2025, 4, 24))
    loads.load_full(later, whole, D(2025, 4, 24))
    dated = lambda s: loads.read_target(s, "fact_sales").join(loads.read_target(s, "dim_time").select("date_id", "date"), "date_id").drop("date_id")
    assert first < loads.read_target(whole, "fact_sales").count() and rows(dated(parts)) == rows(dated(whole))


def test_one_late_id_does_not_stretch_what_is_read(spark, toy):
    # the touched purchases are the last hundred and one of the first: of 100,000 lines few are read
    from martloom.operators.merge import in_ranges, key_ranges

    path = work_path(spark, "lines")
    lines = spark.range(100_000).select(F.col("id").alias("purchase_id"), F.expr("uuid()").alias("v")).repartitionByRange(20, "purchase_id")
    lines.sortWithinPartitions("purchase_id").write.option("parquet.block.size", 64 << 10).parquet(path)
    touched = spark.range(99_900, 100_000).union(spark.range(3, 4)).toDF("id")
    ranges = key_ranges(touched, "id")
    assert len(ranges) == 2
    found = in_ranges(spark.read.parquet(path), "purchase_id", ranges)
    assert found.count() == 101
    found.write.format("noop").mode("overwrite").save()
    assert scanned_rows(found) < 10_000
    one = spark.read.parquet(path).where(F.col("purchase_id").between(3, 99_999))
    one.write.format("noop").mode("overwrite").save()
    assert scanned_rows(one) > 90_000


def scanned_rows(df):
    """Rows the file scan of an executed frame gave out, by its own metric."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    leaves = node.collectLeaves()
    total = 0
    for k in range(leaves.size()):
        total += leaves.apply(k).metrics().apply("numOutputRows").value()
    return total


def test_a_snapshot_of_a_day_already_loaded_reads_new_rows_only(spark, toy):
    store = new_store(spark)
    loads.load_full(toy, store, DAY1, high=MARK)
    loads.load_incremental(toy, store, HIGH, DAY2)
    before = rows(loads.read_target(store, "fact_inventory").where("date_id = 6"))
    more = toy["inventory"].withColumn("quantity", F.col("quantity") + 5).unionByName(
        spark.createDataFrame([(3, 1, 2, 40, dt.datetime(2025, 4, 24, 5))], toy["inventory"].schema)
    )
    written = loads.load_incremental({**toy, "inventory": more}, store, HIGH + dt.timedelta(days=1), DAY2, look_back=dt.timedelta(days=9))
    assert written["fact_inventory"] == 1
    assert rows(loads.read_target(store, "fact_inventory").where("date_id = 6")) == sorted([*before, (3, 1, 2, 6, 40)])
    loads.load_full(toy, store, DAY2)  # numbers days anew: what was seen no longer counts
    assert loads.last_mark(store) is not None and store.read(loads.SNAPSHOT_MARK, loads.DAY_MARK).count() == 0


def test_readers_never_see_new_dimensions_with_old_facts(spark, toy):
    store = new_store(spark)
    loads.load_full(toy, store, DAY1, high=MARK)
    reader = TableStore(spark, store.root)
    seen = []
    for name in ("append", "upsert", "replace"):
        write = getattr(store, name)

        def watched(table, *args, _write=write, **kw):
            rows_written = _write(table, *args, **kw)
            seen.append((loads.read_target(reader, "dim_time").count(), loads.read_target(reader, "fact_sales").count()))
            return rows_written

        setattr(store, name, watched)
    loads.load_incremental(toy, store, HIGH, DAY2)
    assert len(seen) >= 4 and set(seen) == {(3, 3)}
    assert loads.read_target(reader, "dim_time").count() == 6 and loads.read_target(reader, "fact_sales").count() == 6


def test_a_full_load_counts_the_lines_it_leaves_out(spark, toy):
    written = loads.load_full(toy, new_store(spark), DAY2, count_dropped=True)
    assert {k: v for k, v in written.items() if k.startswith("dropped_")} == {"dropped_no_date": 0, "dropped_no_status": 1, "dropped_no_price": 1}
    assert written["fact_sales"] == toy["purchases_items"].count() - 2


def test_judged_sales_are_the_fact_and_its_dropped_lines(spark, toy):
    days = dims.dim_time(toy["purchases"])
    given = toy["purchases"], toy["purchases_status"], toy["purchases_items"], toy["prices"]
    judged = facts.judged_sales(*given, days)
    assert rows(judged.where("_status and _price").drop("_status", "_price")) == rows(facts.fact_sales(*given, days, keep_year=True))
    assert judged.where("_status is null").count() == 1 and judged.where("_price is null").count() == 1


def test_increment_joins_its_lines_once(spark, toy, monkeypatch):
    # lines that wait for a status or a price are counted on the stored batch, not by a second pass over the lines
    store = new_store(spark)
    loads.load_full(toy, store, DAY2, high=OLD)
    monkeypatch.setattr(facts, "dropped_lines", lambda *_: pytest.fail("a second pass over the lines"))
    written = loads.load_incremental({**toy, "purchases_status": toy["purchases_status"].where("purchase_id <> 6")}, store, NEW, DAY2)
    assert {k: v for k, v in written.items() if k.startswith("dropped_")} == {"dropped_no_date": 0, "dropped_no_status": 1, "dropped_no_price": 0}


def test_kept_views_are_read_from_storage(spark):
    t = Inputs(spark, SF_DIR)
    whole = t.purchases_items
    t.keep("purchases_items")
    assert "Aggregate" not in t.bundle("purchases_items")["purchases_items"]._jdf.queryExecution().executedPlan().toString()
    assert t.purchases_items.schema == whole.schema and t.purchases_items.exceptAll(whole).isEmpty() and whole.exceptAll(t.purchases_items).isEmpty()


def test_what_a_task_reads_of_a_shuffle_is_bounded(spark):
    name, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        for given, kept in (("64m", "8m"), ("67108864b", "8m"), ("1m", "1m")):
            spark.conf.set(name, given)
            assert prepare(spark).conf.get(name) == kept
    finally:
        spark.conf.set(name, before)


def _stored(monkeypatch, *modules) -> list[str]:
    """Purposes for which the modules write frames down from here on."""
    seen = []
    for module in modules:
        monkeypatch.setattr(module, "materialize", lambda df, purpose="cut": seen.append(purpose) or materialize(df, purpose))
    return seen


def test_verdicts_read_twice_are_stored(spark, monkeypatch):
    from registry import loads as queries

    seen = _stored(monkeypatch, queries)
    queries.inv_rejected_lines(Inputs(spark, SF_DIR))
    assert seen == ["judged"]


def test_basket_lines_are_stored_once(spark, monkeypatch):
    from martloom.operators import stock
    from martloom.plans import registration
    from registry import loads as queries

    seen = _stored(monkeypatch, stock, registration)
    queries.ord_register(Inputs(spark, SF_DIR))
    assert [p for p in seen if "lines" in p] == ["lines"]


def _shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def test_shuffle_files_end_with_the_write_behind_them(spark):
    before, store = _shuffle_files(spark), new_store(spark)
    grouped = spark.range(10_000).groupBy((F.col("id") % 701).alias("k")).count()
    once_per_key(materialize(grouped), ["k"])
    assert store.replace("grouped", grouped) == 701
    until = time.time() + 20  # files are dropped behind the query, not by it
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left


def test_blocks_that_end_shuffles_may_overlap(spark):
    before, inside, done, seen = spark.conf.get(SHUFFLES_END, None), threading.Event(), threading.Event(), []

    def other():
        with shuffles_end(spark):
            inside.set()
            done.wait(20)
            seen.append(spark.conf.get(SHUFFLES_END))

    thread = threading.Thread(target=other)
    with shuffles_end(spark):
        thread.start()
        assert inside.wait(20)
    assert spark.conf.get(SHUFFLES_END) == "true"  # the other block is open still
    done.set()
    thread.join()
    assert seen == ["true"] and spark.conf.get(SHUFFLES_END, None) == before


def test_slices_hold_every_key_once(spark):
    keys = spark.range(1000).select((F.col("id") * 3 - 500).alias("k")).union(spark.range(900).select(F.lit(40).cast("bigint")))
    keys = keys.union(spark.range(5).select(F.lit(None).cast("bigint")))
    assert key_slices(keys, "k", 5000, 8) == [(-500, 2497)] and key_slices(keys.where("k is null"), "k", 5, 8) == []
    for size, most in ((1000, 2), (300, 8), (1, 8)):
        cuts = key_slices(keys, "k", size, most)
        assert 1 < len(cuts) <= most and cuts[0][0] == -500 and cuts[-1][1] == 2497
        assert all(a[1] + 1 == b[0] and a[0] <= a[1] for a, b in zip(cuts, cuts[1:], strict=False))
        assert sum(keys.where(F.col("k").between(*c)).count() for c in cuts) == 1900


def test_facts_joined_in_slices_are_the_same_and_one_slice_is_stored_at_a_time(spark, toy, monkeypatch):
    whole, parts = new_store(spark), new_store(spark)
    for store, size in ((whole, loads.SLICE), (parts, 1)):
        monkeypatch.setattr(loads, "SLICE", size)
        joined, open_now = [], []

        def stored(df, purpose="cut", _open=open_now, _joined=joined):
            kept = materialize(df, purpose)
            if purpose == "judged-sales":
                _open.append(kept.inputFiles()[0].rsplit("/", 1)[0])
                _joined.append(sum(map(_is_there(spark), _open)))
            return kept

        monkeypatch.setattr(loads, "materialize", stored)
        first = loads.load_full(toy, store, DAY1, high=MARK)
        second = loads.load_incremental(toy, store, HIGH, DAY2, look_back=dt.timedelta(days=9))
        assert first["fact_sales"] == 3 and second["fact_sales"] == 3
        assert {k: v for k, v in second.items() if k.startswith("dropped_")} == {"dropped_no_date": 0, "dropped_no_status": 1, "dropped_no_price": 1}
        assert set(joined) == {1} and (len(joined) > 1) == (size == 1)
    assert dated(parts) == dated(whole)
    assert store.rows("fact_sales") == 6


def _is_there(spark):
    def there(path):
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)

    return there


@pytest.fixture
def shop(spark):
    """Raw tables of 21 parts and 40 orders with two lines each, half of the orders before the first mark."""
    root, midnight = work_path(spark, "shop"), dt.datetime(2000, 6, 1)
    rows_by_table = {
        "nation": [(1, "BRAZIL", 1)],
        "customer": [(1, "Customer#1", 1, 1.0, "X")],
        "supplier": [(1, "Supplier#1", 1, 1.0)],
        "part": [(k, f"part {k}", "B", "T", k % 3, 10.0 + k) for k in range(1, 22)],
        "orders": [(k, 1, "O", 1.0, midnight + dt.timedelta(days=k + 365 * (k > 20)), "1") for k in range(1, 41)],
        "lineitem": [
            (k, (k + n) % 21 + 1, 1, n, 2.0, 1.0, 0.0, 0.0, "N", "O", midnight + dt.timedelta(days=k)) for k in range(1, 41) for n in (1, 2)
        ],
    }
    for name, some in rows_by_table.items():
        spark.createDataFrame(some, testdata.RAW[name]).write.parquet(f"{root}/{name}.parquet")
    return root


def test_late_prices_are_missing_from_the_first_load_and_come_with_the_next(spark, shop, monkeypatch):
    from registry.base import LOW
    from registry.loads import inc_late_price

    seen, full, touch = {}, loads.load_full, loads.touched_purchases

    def load_full(tables, store, *args, **named):
        written = full(tables, store, *args, **named)
        seen["first"] = {tuple(r) for r in loads.read_target(store, "fact_sales").select("purchase_id", "item_id").collect()}
        seen["own"] = {r[0] for r in tables["purchases"].where(F.col("created_at") <= F.lit(LOW).cast("timestamp_ntz")).select("id").collect()}
        return written

    def touched(delta, tables, high):
        found = touch(delta, tables, high)
        seen["touched"] = {r[0] for r in found.select("id").collect()}
        return found

    monkeypatch.setattr(loads, "load_full", load_full)
    monkeypatch.setattr(loads, "touched_purchases", touched)
    lines = {(k, (k + n) % 21 + 1) for k in range(1, 41) for n in (1, 2) if k % 100 != 7}
    found = {tuple(r) for r in inc_late_price(Inputs(prepare(spark), shop)).select("purchase_id", "item_id").collect()}
    early = {(p, i) for p, i in lines if p in seen["own"]}
    assert found == lines and seen["first"] == {(p, i) for p, i in early if i % 7}
    # of older purchases those with a late price are looked at again, no others
    assert seen["touched"] & seen["own"] == {p for p in seen["own"] if any((p + n) % 21 % 7 == 6 for n in (1, 2))}
