"""One key holds a third of all rows: the plan has to cut it up."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martloom.plans import dims, facts
from martloom.session import prepare, work_path

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


@pytest.fixture
def tight(spark):
    prepare(spark)
    before = {k: spark.conf.get(k) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def test_hot_purchase_is_split_in_both_joins(tight):
    spark, root, n = tight, work_path(tight, "skew"), 300_000
    hot = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20_000)
    tables = {
        "lines": spark.range(n).select(
            hot.alias("purchase_id"), (F.col("id") % 500).alias("item_id"), F.col("id").alias("size_id"), F.lit(2).alias("quantity")
        ),
        "prices": spark.range(n).select(
            (F.col("id") % 500).alias("item_id"), F.col("id").alias("size_id"), F.lit(1.5).cast("decimal(10,2)").alias("value")
        ),
        "purchases": spark.range(20_000).select(
            "id", F.col("id").alias("customer_id"), F.lit(1).cast("bigint").alias("store_id"), F.lit(dt.date(2020, 1, 1)).alias("order_date")
        ),
        "status": spark.range(20_000).select(F.col("id").alias("purchase_id"), F.lit("Sent").alias("status")),
    }
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
    t = {name: spark.read.parquet(f"{root}/{name}") for name in tables}
    sales = facts.fact_sales(t["purchases"], t["status"], t["lines"], t["prices"], dims.dim_time(t["purchases"]))
    assert len(sales.collect()) == n
    final = sales._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("SortMergeJoin(skew=true) [purchase_id") == 2
