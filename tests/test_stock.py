import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martloom.operators.stock import allocate, apply_decrements, check_stock, orders_without_lines, rejected_lines


def brute_force(lines, stock):
    left, verdicts = dict(stock), {}
    for key, seq, qty in sorted(lines, key=lambda x: x[1]):
        have = left.get(key, 0)
        verdicts[key, seq] = qty is not None and qty <= have
        if verdicts[key, seq]:
            left[key] = have - qty
    return verdicts


def run(spark, lines, stock, max_group):
    frame = spark.createDataFrame(lines, "k long, seq long, quantity int")
    held = spark.createDataFrame(list(stock.items()), "k long, quantity long")
    judged = allocate(frame, held, ["k"], ["seq"], max_group=max_group)
    return {(r.k, r.seq): r.accepted for r in judged.collect()}


@pytest.mark.parametrize("max_group", [10_000, 150, 20])
def test_allocation_agrees_with_a_plain_loop(spark, max_group):
    rng = random.Random(5)
    lines = [(rng.choice([1, 1, 1, 2, 3, 4, 5]), i, rng.randint(1, 40)) for i in range(3000)]
    stock = {1: 4000, 2: 10**6, 3: 0, 4: 39}  # key 5 has no stock row
    assert run(spark, lines, stock, max_group) == brute_force(lines, stock)


def test_hot_null_key_is_refused_in_pieces(spark):
    lines = [(None, i, 1) for i in range(300)] + [(1, 300, 2), (1, 301, 2)]
    verdicts = run(spark, lines, {1: 3}, 50)
    assert len(verdicts) == 302 and [k for k, ok in verdicts.items() if ok] == [(1, 300)]


def test_every_refusal_lowers_the_bar(spark):
    # 1, 100, 1, 99, 1, 98 …: each large line just fails to fit, as many rounds as there can be
    lines = []
    for i in range(40):
        lines += [(1, 2 * i, 1), (1, 2 * i + 1, 100 - i)]
    stock = {1: 100}
    assert run(spark, lines, stock, 4) == brute_force(lines, stock)


def test_skipped_line_leaves_stock_for_a_smaller_one(spark):
    lines = [(1, 1, 3), (1, 2, 5), (1, 3, 2), (1, 4, None)]
    assert run(spark, lines, {1: 5}, 100) == {(1, 1): True, (1, 2): False, (1, 3): True, (1, 4): False}


def test_accepted_never_exceeds_stock(spark):
    rng = random.Random(9)
    lines = [(rng.randint(1, 3), i, rng.randint(1, 9)) for i in range(500)]
    verdicts = run(spark, lines, {1: 100, 2: 250, 3: 7}, 60)
    for key, held in {1: 100, 2: 250, 3: 7}.items():
        assert sum(q for k, i, q in lines if k == key and verdicts[k, i]) <= held


def test_check_decrement_and_rejects(spark):
    lines = spark.createDataFrame([(1, 1, 3), (1, 2, 9), (2, 2, 1)], "k int, o int, quantity int")
    stock = spark.createDataFrame([(1, 5)], "k int, quantity long")
    checked = check_stock(lines, stock, ["k"])
    assert rows(checked) == [(1, 1, 3, True), (1, 2, 9, False), (2, 2, 1, False)]
    judged = checked.withColumnRenamed("in_stock", "accepted")
    assert rows(rejected_lines(judged)) == [(1, 2, 9), (2, 2, 1)]
    assert rows(orders_without_lines(judged, "o")) == [(2,)]
    left = apply_decrements(stock, judged.where("accepted"), ["k"])
    assert rows(left) == [(1, 2)] and left.schema == stock.schema


def test_hot_key_is_cut_into_bounded_groups(spark):
    # one key holds a third of all rows: no fold group may exceed the limit
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1)
    lines = spark.range(n).select(key.alias("k"), F.col("id").alias("seq"), (F.col("id") % 5 + 1).alias("quantity"))
    stock = spark.createDataFrame([(0, 20_000)], "k long, quantity long")
    judged = allocate(lines, stock, ["k"], ["seq"], max_group=500)
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert "_chunk" in plan
    got = {r.seq: r.accepted for r in judged.where("k = 0").collect()}
    want = brute_force([(0, i, i % 5 + 1) for i in range(0, n, 3)], {0: 20_000})
    assert got == {seq: ok for (_, seq), ok in want.items()}
    assert judged.count() == n


def test_ties_are_taken_in_one_order_at_any_group_size(spark):
    rng = random.Random(11)
    lines = [(rng.choice([1, 1, 2]), rng.randint(1, 60), rng.randint(1, 9), f"t{i}") for i in range(800)]
    frame = spark.createDataFrame(lines, "k long, seq long, quantity int, tag string")
    held = spark.createDataFrame([(1, 1500), (2, 400)], "k long, quantity long")
    small, large = (rows(allocate(frame, held, ["k"], ["seq"], max_group=m)) for m in (30, 10_000))
    assert small == large


def test_quantities_must_be_positive(spark):
    for bad in (0, -30):
        with pytest.raises(Exception, match="not positive"):
            run(spark, [(1, 1, bad), (1, 2, 20)], {1: 35}, 100)
