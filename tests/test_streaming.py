import datetime as dt

from conftest import D, rows
from pyspark.sql import functions as F

from martloom.operators.stock import allocate
from martloom.operators.store import TableStore
from martloom.plans import loads
from martloom.schema import SOURCES
from martloom.session import work_path
from martloom.sources.tables import read_files
from martloom.streaming import loads as streams

DAY = D(2025, 4, 24)


def test_sales_stream_equals_full_load(spark, toy):
    root, source = work_path(spark, "stream"), work_path(spark, "purchases")
    # two files, hence two micro-batches; the second repeats a purchase of the first
    toy["purchases"].where("id <= 3").coalesce(1).write.parquet(source)
    toy["purchases"].where("id >= 3").coalesce(1).write.mode("append").parquet(source)
    stream = read_files(spark, source, SOURCES["purchases"].struct, files_per_batch=1)
    streams.stream_sales(stream, toy, root, f"{root}/checkpoint", DAY).awaitTermination()
    store, whole = TableStore(spark, root), TableStore(spark, work_path(spark, "whole"))
    loads.load_full(toy, whole, DAY)
    for name in ("fact_sales", "dim_customers", "dim_stores", "dim_items", "dim_sizes"):
        got, want = loads.read_target(store, name), loads.read_target(whole, name)
        if name == "fact_sales":
            got, want = (
                df.join(loads.read_target(s, "dim_time").select("date_id", "date"), "date_id").drop("date_id")
                for df, s in ((got, store), (want, whole))
            )
        assert rows(got) == rows(want), name
    assert loads.last_mark(store) == dt.datetime(2025, 4, 23)


def test_stream_may_go_on_at_an_interval(spark):
    root, source = work_path(spark, "stream"), work_path(spark, "rows")
    data = spark.range(10).select("id", F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz").alias("ts"))
    data.write.parquet(source)
    stream = read_files(spark, source, data.schema)
    running = streams.stream_insert_ignore(stream, root, "t", ["id"], "ts", f"{root}/c", every="1 second")
    try:
        running.processAllAvailable()
        data.withColumn("id", F.col("id") + 5).write.mode("append").parquet(source)
        running.processAllAvailable()
    finally:
        running.stop()
    assert TableStore(spark, root).read("t", data.schema).count() == 15


def test_stream_insert_ignore_is_idempotent(spark):
    root, source = work_path(spark, "stream"), work_path(spark, "rows")
    data = spark.range(100).select("id", F.lit(dt.datetime(2025, 1, 1)).cast("timestamp_ntz").alias("ts"))
    data.write.parquet(source)
    for attempt in range(2):
        stream = read_files(spark, source, data.schema)
        streams.stream_insert_ignore(stream, root, "t", ["id"], "ts", f"{root}/c{attempt}").awaitTermination()
    assert TableStore(spark, root).read("t", data.schema).count() == 100


def test_allocation_carries_stock_between_batches(spark):
    root, source = work_path(spark, "stream"), work_path(spark, "lines")
    lines = spark.range(600).select((F.col("id") % 4).alias("k"), F.col("id").alias("seq"), (F.col("id") % 7 + 1).cast("int").alias("quantity"))
    for low in (0, 200, 400):  # three files, three micro-batches in order
        lines.where(f"seq >= {low} and seq < {low + 200}").coalesce(1).write.mode("append").parquet(source)
    stock = spark.createDataFrame([(0, 90), (1, 300), (2, 10_000)], "k long, quantity long")
    store = TableStore(spark, root)
    streams.open_stock(store, stock)

    def drain():
        stream = read_files(spark, source, lines.schema, files_per_batch=1)
        streams.stream_allocate(
            stream, root, stock.schema, ["k"], ["seq"], f"{root}/checkpoint", max_group=20
        ).awaitTermination()

    drain()
    drain()  # nothing new: nothing happens
    judged = streams.read_allocated(spark, root, lines.schema)
    want = allocate(lines, stock, ["k"], ["seq"])
    assert rows(judged, "k", "seq", "accepted") == rows(want, "k", "seq", "accepted")
    left = streams.stock_left(spark, root, stock.schema, ["k"])
    taken = want.where("accepted").groupBy("k").agg(F.sum("quantity").alias("t"))
    assert rows(left) == rows(stock.join(taken, "k").select("k", F.col("quantity") - F.col("t")))


def test_replayed_batch_is_not_taken_twice(spark):
    root, source = work_path(spark, "stream"), work_path(spark, "lines")
    lines = spark.createDataFrame([(1, 1, 5)], "k long, seq long, quantity int")
    lines.write.parquet(source)
    stock = spark.createDataFrame([(1, 12)], "k long, quantity long")
    store = TableStore(spark, root)
    streams.open_stock(store, stock)
    for attempt in range(2):  # the second query starts again at batch 0
        stream = read_files(spark, source, lines.schema)
        streams.stream_allocate(stream, root, stock.schema, ["k"], ["seq"], f"{root}/c{attempt}").awaitTermination()
    assert rows(streams.stock_left(spark, root, stock.schema, ["k"])) == [(1, 7)]
    assert streams.read_allocated(spark, root, lines.schema).count() == 1
    # a line that no earlier checkpoint saw is judged, though its batch number was used before
    spark.createDataFrame([(1, 2, 6), (1, 3, 4)], lines.schema).write.mode("append").parquet(source)
    stream = read_files(spark, source, lines.schema)
    streams.stream_allocate(stream, root, stock.schema, ["k"], ["seq"], f"{root}/c2").awaitTermination()
    assert rows(streams.read_allocated(spark, root, lines.schema), "seq", "accepted") == [(1, True), (2, True), (3, False)]
    assert rows(streams.stock_left(spark, root, stock.schema, ["k"])) == [(1, 1)]


def test_allocation_from_an_empty_stock(spark):
    root, source = work_path(spark, "stream"), work_path(spark, "lines")
    lines = spark.createDataFrame([(1, 1, 5)], "k long, seq long, quantity int")
    lines.write.parquet(source)
    stock = spark.createDataFrame([], "k long, quantity long")
    streams.open_stock(TableStore(spark, root), stock)
    stream = read_files(spark, source, lines.schema)
    streams.stream_allocate(stream, root, stock.schema, ["k"], ["seq"], f"{root}/c").awaitTermination()
    assert rows(streams.read_allocated(spark, root, lines.schema), "seq", "accepted") == [(1, False)]


def test_streams_under_one_root_keep_their_own_marks_and_read_few_folders(spark):
    root, source = work_path(spark, "stream"), work_path(spark, "rows")
    rows_of = lambda low, high, day: spark.range(low, high).select("id", F.lit(dt.datetime(2025, 1, day)).cast("timestamp_ntz").alias("ts"))
    for n in range(4):
        rows_of(1000 * n, 1000 * n + 100, 5).coalesce(1).write.mode("append").parquet(source)
    rows_of(10, 20, 9).coalesce(1).write.parquet(f"{source}-b")
    schema = rows_of(0, 1, 1).schema
    for table, path in (("a", source), ("b", f"{source}-b")):
        stream = read_files(spark, path, schema, files_per_batch=1)
        streams.stream_insert_ignore(stream, root, table, ["id"], "ts", f"{root}/c-{table}").awaitTermination()
    store = TableStore(spark, root)
    assert loads.last_mark(store, "a") == dt.datetime(2025, 1, 5) and loads.last_mark(store, "b") == dt.datetime(2025, 1, 9)
    assert store.read("a", schema).count() == 400 and len(store._tables()["a"]["parts"]) == 4
    near = store.read_near("a", schema, "id", [(2050, 2060)])
    assert near.count() == 11 and len({f.rsplit("/", 2)[1] for f in near.inputFiles()}) == 1
    assert store.read_near("a", schema, "id", [(200, 300)]).count() == 0


def test_what_a_batch_reads_does_not_grow_with_the_batches_before(spark, monkeypatch):
    monkeypatch.setattr(streams, "COMPACT_EVERY", 3)
    root, source = work_path(spark, "stream"), work_path(spark, "lines")
    lines = spark.range(400).select((F.col("id") % 3).alias("k"), F.col("id").alias("seq"), (F.col("id") % 5 + 1).cast("int").alias("quantity"))
    for n in range(10):
        lines.where(f"seq div 40 = {n}").coalesce(1).write.mode("append").parquet(source)
    stock = spark.createDataFrame([(0, 90), (1, 300), (2, 10_000)], "k long, quantity long")
    streams.open_stock(TableStore(spark, root), stock)
    read = []
    given = streams._moved

    def counted(*args):
        moved = given(*args)
        read.append(len({f.rsplit("/", 1)[0] for f in moved.inputFiles()}))
        return moved

    monkeypatch.setattr(streams, "_moved", counted)
    stream = read_files(spark, source, lines.schema, files_per_batch=1)
    streams.stream_allocate(stream, root, stock.schema, ["k"], ["seq"], f"{root}/checkpoint").awaitTermination()
    assert len(read) == 10 and max(read) <= 4
    judged = streams.read_allocated(spark, root, lines.schema)
    assert rows(judged, "k", "seq", "accepted") == rows(allocate(lines, stock, ["k"], ["seq"]), "k", "seq", "accepted")
    taken = judged.where("accepted").groupBy("k").agg(F.sum("quantity").alias("t"))
    left = stock.join(taken, "k").select("k", F.col("quantity") - F.col("t"))
    assert rows(streams.stock_left(spark, root, stock.schema, ["k"])) == rows(left)
    assert streams.compact_ledger(spark, root, stock.schema, ["k"]) == 1 and streams.compact_ledger(spark, root, stock.schema, ["k"]) == 0
    assert rows(streams.stock_left(spark, root, stock.schema, ["k"])) == rows(left)
