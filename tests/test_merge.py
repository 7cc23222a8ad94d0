import pytest
from conftest import rows
from pyspark.sql import functions as F

from martloom.operators.keys import dense_ids, max_key, pair_by_position
from martloom.operators.merge import (
    RANGES,
    difference,
    first_per_key,
    in_ranges,
    insert_ignore,
    key_ranges,
    last_per_key,
    merged,
    once_per_key,
    rows_to_insert,
    upsert,
)
from martloom.operators.store import TableStore
from martloom.session import materialize, staging, work_path

SCHEMA = "k int, a string, b string"


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_first_and_last_per_key(spark):
    df = frame(spark, [(1, "x", 2), (1, "y", 1), (2, None, 5)], "k int, a string, n int")
    assert rows(first_per_key(df, ["k"], ["n"])) == [(1, "y", 1), (2, None, 5)]
    assert rows(last_per_key(df, ["k"], ["n"])) == [(1, "x", 2), (2, None, 5)]


def test_insert_ignore_keeps_target_and_first_source_row(spark):
    target = frame(spark, [(1, "old", None)])
    source = frame(spark, [(1, "new", "n"), (2, "b", "2"), (2, "a", "9")])
    assert rows(insert_ignore(target, source, ["k"], ["a"])) == [(1, "old", None), (2, "a", "9")]
    again = insert_ignore(insert_ignore(target, source, ["k"], ["a"]), source, ["k"], ["a"])
    assert again.count() == 2


def test_rows_to_insert_reads_touched_partitions_only(spark):
    path = work_path(spark, "touched")
    spark.range(3000).select("id", (F.col("id") % 30 + 1990).cast("int").alias("year")).write.partitionBy("year").parquet(path)
    stored = spark.read.parquet(path)
    batch = frame(spark, [(3, 1993), (33, 1993), (9993, 1993)], "id long, year int")
    fresh = rows_to_insert(stored, batch, ["id"], within="year")
    assert rows(fresh) == [(9993, 1993)]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and " = 1993)" in plan


def test_upsert_updates_listed_columns_and_takes_last_row(spark):
    target = frame(spark, [(1, "a1", "b1"), (2, "a2", "b2")])
    source = frame(spark, [(1, "x", "y", 1), (1, None, "z", 2), (3, "a3", None, 1)], SCHEMA + ", n int")
    merged = upsert(target, source, ["k"], ["a"], ["n"])
    # null is a value, b of key 1 is not in the list, key 3 is inserted whole
    assert rows(merged) == [(1, None, "b1"), (2, "a2", "b2"), (3, "a3", None)]


def test_difference(spark):
    left = frame(spark, [(1, "", ""), (1, "", ""), (2, "", "")])
    assert rows(difference(left, frame(spark, [(2, "", "")]), ["k"])) == [(1,)]


@pytest.mark.parametrize("partitions", [None, 1, 7])
def test_dense_ids(spark, partitions):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    numbered = dense_ids(df, ["v"], "n", start=11, partitions=partitions)
    got = [tuple(r) for r in numbered.orderBy("v").collect()]
    assert [n for _, n in got] == list(range(11, 5011))
    assert [v for v, _ in got] == sorted(v for v, _ in got)


def test_pair_by_position_ends_with_the_shorter(spark):
    left, right = spark.range(5).toDF("a"), spark.range(10, 13).toDF("b")
    paired = pair_by_position(left, ["a"], right, ["b"])
    assert rows(paired, "a", "b") == [(0, 10), (1, 11), (2, 12)]


def test_max_key_of_empty_table(spark):
    assert max_key(spark.range(0), "id") == 0
    assert max_key(spark.range(4), "id") == 3


def test_store_versions(spark):
    store = TableStore(spark, work_path(spark, "store"), max_rows_per_file=100)
    schema = spark.range(0).schema
    assert store.read("t", schema).count() == 0
    assert store.replace("t", spark.range(250)) == 250
    old = store.read("t", schema)
    assert store.replace("t", old.where("id < 10")) == 10  # a table may be rewritten from itself
    assert store.read("t", schema).count() == 10 and old.count() == 250
    assert store.append("t", spark.range(100, 105)) == 5
    assert store.read("t", schema).count() == 15
    assert store.current("t").endswith("v=2")


def test_store_keeps_the_last_versions(spark):
    store = TableStore(spark, work_path(spark, "store"), keep=2)
    for n in range(1, 5):
        store.replace("t", spark.range(n))
    assert store._versions("t", "") == [3, 4]
    assert store.read("t", spark.range(0).schema).count() == 4


def test_staged_files_go_with_their_block(spark):
    import os

    with staging(spark):
        inside = materialize(spark.range(5))
        where = inside.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(where)
    assert not os.path.exists(where)
    outside = materialize(spark.range(5))
    assert outside.count() == 5


def test_store_passes_over_unfinished_versions(spark):
    store = TableStore(spark, work_path(spark, "store"))
    store.replace("t", spark.range(3))
    # a version whose write never finished: files, but no marker
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{store.root}/t/v=2")
    assert store.read("t", spark.range(0).schema).count() == 3
    store.replace("t", spark.range(4))
    assert store.current("t").endswith("v=3")


def test_row_limit_per_file_and_sorted_row_groups(spark):
    import pyarrow.parquet as pq

    store = TableStore(spark, work_path(spark, "store"), max_rows_per_file=100)
    store.replace("t", spark.range(250).coalesce(1).select("id", F.lit(1).alias("p")), ["p"], ["id"])
    files = spark.read.parquet(store.current("t")).inputFiles()
    sizes, ranges = [], []
    for f in files:
        column = pq.ParquetFile(f.removeprefix("file://")).metadata.row_group(0).column(0).statistics
        ranges.append((column.min, column.max))
        sizes.append(column.num_values)
    assert sorted(sizes) == [50, 100, 100]
    assert sorted(ranges) == [(0, 99), (100, 199), (200, 249)]


def test_small_batch_moves_no_target_row(spark):
    root = work_path(spark, "sides")
    spark.range(50_000).select("id", F.lit("x").alias("v")).write.parquet(f"{root}/target")
    spark.range(49_990, 50_010).select("id", F.lit("y").alias("v")).write.parquet(f"{root}/batch")
    target, batch = spark.read.parquet(f"{root}/target"), spark.read.parquet(f"{root}/batch")
    for merged in (upsert(target, batch, ["id"], ["v"]), rows_to_insert(target, batch, ["id"], ranged="id")):
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert upsert(target, batch, ["id"], ["v"]).where("v = 'y'").count() == 20
    assert rows_to_insert(target, batch, ["id"], ranged="id").count() == 10


def test_one_pass_upsert_agrees_with_upsert(spark):
    target = frame(spark, [(1, "a1", None), (2, "a2", "b2"), (3, None, "b3")])
    source = frame(spark, [(1, None, "y"), (3, "x", None), (4, None, None), (5, "a5", "b5")])
    found = merged(target, source, ["k"], ["a"])
    assert rows(found.drop("_new")) == rows(upsert(target, source, ["k"], ["a"]))
    assert rows(found.where("_new"), "k") == [(4,), (5,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") == 1


def test_key_ranges_leave_out_the_widest_gaps(spark):
    ids = [*range(100, 200), 5, 10**12, *range(5_000_000, 5_000_050)]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long")
    ranges = key_ranges(df, "id")
    assert all(any(a <= i <= b for a, b in ranges) for i in ids) and len(ranges) <= RANGES
    assert ranges[-1] == (10**12, 10**12)
    scattered = spark.range(0, 10**9, 999_983).toDF("id")
    ranges = key_ranges(scattered, "id")
    assert len(ranges) == RANGES and in_ranges(scattered, "id", ranges).count() == scattered.count()
    assert key_ranges(df.limit(0), "id") == [] and in_ranges(df, "id", []).count() == 0


def test_a_killed_append_leaves_readers_on_the_old_rows(spark):
    store = TableStore(spark, work_path(spark, "store"))
    schema = spark.range(0).schema
    store.replace("t", spark.range(5))
    failing = spark.range(100, 2100, numPartitions=20).select(F.expr("if(id = 2099, cast(raise_error('killed') as bigint), id)").alias("id"))
    with pytest.raises(Exception, match="killed"):
        store.append("t", failing)
    other = TableStore(spark, store.root)  # a reader that starts now
    assert other.read("t", schema).count() == 5
    assert store.append("t", spark.range(5, 8)) == 3 and other.read("t", schema).count() == 8
    assert store.append("t", spark.range(0)) == 0 and other.read("t", schema).count() == 8


def test_writes_of_several_tables_count_from_one_moment_on(spark):
    store, schema = TableStore(spark, work_path(spark, "store")), spark.range(0).schema
    store.replace("a", spark.range(1))
    reader = TableStore(spark, store.root)
    with store.as_one():
        store.append("a", spark.range(1, 3))
        assert reader.read("a", schema).count() == 1 and store.read("a", schema).count() == 3
        store.replace("b", spark.range(7))
        assert not reader.exists("b") and store.exists("b")
    assert reader.read("a", schema).count() == 3 and reader.read("b", schema).count() == 7
    with pytest.raises(RuntimeError), store.as_one():
        store.replace("a", spark.range(50))
        raise RuntimeError
    assert reader.read("a", schema).count() == 3 and store.read("a", schema).count() == 3


def test_many_appends_of_a_partitioned_table(spark, monkeypatch):
    from martloom.operators import store as module

    monkeypatch.setattr(module, "MAX_PARTS", 6)
    store = TableStore(spark, work_path(spark, "store"))
    years = lambda low, high: spark.range(low, high).select("id", (F.col("id") % 3 + 2000).cast("int").alias("year"))
    schema = years(0, 1).schema
    store.replace("t", years(0, 0), ["year"])
    for n in range(15):
        store.append("t", years(10 * n, 10 * n + 10), ["year"], ["id"])
    assert rows(store.read("t", schema)) == rows(years(0, 150))
    assert len(store._tables()["t"]["parts"]) <= 6
    plan = store.read("t", schema).where("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert "= 2001)" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_upsert_writes_only_the_buckets_it_touches(spark):
    import os

    store = TableStore(spark, work_path(spark, "store"), rows_per_bucket=100, keep=1)
    frame_of = lambda low, high, v: spark.range(low, high).select(F.col("id").alias("k"), F.lit(v).alias("a"), F.lit(v).alias("b"))
    schema = frame_of(0, 1, "x").schema
    store.replace("t", frame_of(0, 1000, "x"))
    assert store.upsert("t", frame_of(990, 1010, "y"), ["k"], ["a"], schema) == 1010  # ten times over the size: buckets
    before = {p: os.path.getmtime(f"{store.root}/t/{p}".removeprefix("file:")) for p in store._tables()["t"]["parts"]}
    assert len(before) > 8
    batch = frame_of(5, 6, "z").unionByName(frame_of(2000, 2001, "z"))
    assert store.upsert("t", batch, ["k"], ["a"], schema) == 1011
    after = store._tables()["t"]["parts"]
    kept = [p for p in after if p in before]
    assert len(after) - len(kept) <= 2 and len(kept) >= len(before) - 2
    assert all(os.path.getmtime(f"{store.root}/t/{p}".removeprefix("file:")) == before[p] for p in kept)
    got = {r.k: (r.a, r.b) for r in store.read("t", schema).collect()}
    want = {k: ("x", "x") for k in range(990)} | {k: ("y", "x") for k in range(990, 1000)} | {k: ("y", "y") for k in range(1000, 1010)}
    assert got == want | {5: ("z", "x"), 2000: ("z", "z")}
    assert store.upsert("new", batch, ["k"], ["a"], schema) == 2  # a table that isn't there yet


def _operators(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_plain_column_is_picked_by_hash(spark):
    df = spark.createDataFrame([(1, 5), (1, 3), (2, None), (2, 7), (3, None), (None, 4), (None, 2)], "k int, q int")
    assert rows(first_per_key(df, ["k"])) == sorted([(1, 3), (2, None), (3, None), (None, 2)], key=repr)
    assert rows(last_per_key(df, ["k"])) == sorted([(1, 5), (2, 7), (3, None), (None, 4)], key=repr)
    assert "SortAggregate" not in _operators(first_per_key(df, ["k"]))


def test_picked_row_moves_once(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 2), (1, "c", 1), (2, None, 1)], "k int, t string, n int")
    first = first_per_key(df, ["k"], ["n"])
    assert first.columns == ["k", "t", "n"] and rows(first) == [(1, "c", 1), (2, None, 1)]
    assert rows(last_per_key(df, ["k"], ["n"])) == [(1, "b", 2), (2, None, 1)]
    assert "min_by" not in _operators(first)


def test_once_per_key_moves_rows_only_for_repeats(spark):
    schema = "k int, t string, n int"
    alone = spark.createDataFrame([(1, "a", 1), (None, "b", 2)], schema)
    assert once_per_key(alone, ["k"]) is alone
    twice = spark.createDataFrame([(1, "b", 1), (1, "a", 1), (None, "d", 2), (None, "c", 2)], schema)
    assert rows(once_per_key(twice, ["k"])) == sorted([(1, "a", 1), (None, "c", 2)], key=repr)
    assert once_per_key(alone.where("false"), ["k"]).count() == 0


def test_insert_ignore_of_a_large_batch_reads_it_once(spark):
    target = spark.createDataFrame([(1, 10), (2, 20)], "k int, q int")
    source = spark.createDataFrame([(2, 99), (3, 31), (3, 30), (None, 5)], "k int, q int")
    found = insert_ignore(target, source, ["k"], small=False)
    assert rows(found) == rows(insert_ignore(target, source, ["k"]))
    assert "LeftSemi" not in _operators(found)
