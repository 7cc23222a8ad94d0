import datetime as dt
from decimal import Decimal

import pytest
from conftest import OLD, rows
from pyspark.sql import functions as F

from martloom.operators import quality as dq
from martloom.session import work_path
from martloom.schema import SOURCES, TARGETS

# per rule: table, a row that passes and one that breaks it
CASES = {
    "not_null:status": ("purchases_status", (1, "Sent", OLD), (1, None, OLD)),
    "max_length:size": ("sizes", (1, "x" * 10, OLD), (1, "x" * 11, OLD)),
    "max_length:name": ("stores", (1, "ç" * 50, "e", OLD), (1, "ç" * 51, "e", OLD)),
    "domain:status": ("purchases_status", (1, "Canceled", OLD), (1, "Lost", OLD)),
    "domain:phone_type": ("phones", (1, None, "1112345678"), (1, "Fax", "1112345678")),
    "pattern:number": ("phones", (1, "Mobile", "(11) 91234-5678"), (1, "Mobile", "5,12345678")),
    "minimum:value": ("prices", (1, 1, Decimal("0.01"), OLD), (1, 1, Decimal("0.00"), OLD)),
    "minimum:quantity": ("inventory", (1, 1, 1, 0, OLD), (1, 1, 1, -1, OLD)),
    "domain:region": ("dim_stores", (1, "a", None, "SP", "Sul", "01000"), (1, "a", None, "SP", "South", "01000")),
    "domain:state": ("dim_stores", (1, "a", None, "SP", "Sul", "01000"), (1, "a", None, "ZZ", "Sul", "01000")),
    "pattern:zip_code": ("dim_stores", (1, "a", None, "SP", "Sul", "01000-100"), (1, "a", None, "SP", "Sul", "01000-10")),
    "minimum:line_value": (
        "fact_sales",
        (1, 1, 1, None, 1, 1, "Sent", 0.0, 0),
        (1, 1, 1, None, 1, 1, "Sent", -0.5, 0),
    ),
    "minimum:quantity_in_stock": ("fact_inventory", (1, 1, 1, 1, 0), (1, 1, 1, 1, -2)),
    "not_null:date": (
        "dim_time",
        (1, dt.date(2025, 1, 1), 1, 1, 1, 2025, False),
        (1, None, 1, 1, 1, 2025, False),
    ),
}


def loose(spark, table, data):
    # nullable, so that a broken row can be built at all
    schema = table.struct
    for field in schema:
        field.nullable = True
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("rule", CASES)
def test_row_rule(spark, rule):
    name, good, bad = CASES[rule]
    table = {**SOURCES, **TARGETS}[name]
    assert dq.row_violations(loose(spark, table, [good]), table).isEmpty()
    found = dq.row_violations(loose(spark, table, [bad]), table)
    assert [r.rule for r in found.collect()] == [rule]


def test_keys_and_references(spark, toy):
    twice = toy["sizes"].unionByName(toy["sizes"])
    assert rows(dq.duplicate_keys(twice, SOURCES["sizes"]), "rule", "key", "n_rows") == [
        ("primary_key", "1", 2),
        ("primary_key", "2", 2),
    ]
    lost = toy["purchases"].withColumn("customer_id", F.when(F.col("customer_id").isNotNull(), F.col("customer_id") + 1))
    reference = SOURCES["purchases"].references[0]
    found = dq.orphans(lost, SOURCES["purchases"], reference, toy["customers"])
    assert rows(found, "rule", "key", "n_rows") == [("foreign_key:customer_id->customers", "3", 1)]  # guests pass


def test_check_finds_what_the_toy_source_holds(spark, toy):
    found = rows(dq.check(toy, SOURCES), "table_name", "rule", "key")
    assert found == [
        ("inventory", "foreign_key:item_id->items", "9"),
        ("inventory", "foreign_key:size_id->sizes", "9"),
        ("phones", "pattern:number", "2"),
    ]


def test_split_and_enforce(spark, toy):
    good, rejected = dq.split(toy["inventory"], SOURCES["inventory"], {"items": toy["items"], "sizes": toy["sizes"]})
    assert good.count() == 2
    assert rows(rejected, "item_id", "broken_rules") == [
        (9, ["foreign_key:item_id->items", "foreign_key:size_id->sizes"])
    ]
    dq.enforce(dq.check({"sizes": toy["sizes"]}, SOURCES))
    with pytest.raises(dq.RuleViolation, match="inventory"):
        dq.enforce(dq.check(toy, SOURCES))


def test_split_spreads_rows_without_a_key(spark, toy):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        guests = toy["purchases"].withColumn("customer_id", F.lit(None).cast(toy["purchases"].schema["customer_id"].dataType))
        good, rejected = dq.split(guests, SOURCES["purchases"], {"customers": toy["customers"]})
        assert good.count() == guests.count() > 0 and rejected.isEmpty()
        assert good.columns == guests.columns
        lost = toy["purchases"].withColumn("customer_id", F.col("customer_id") + 1000)
        good, rejected = dq.split(lost, SOURCES["purchases"], {"customers": toy["customers"]})
        assert good.where("customer_id is not null").isEmpty()
        assert rejected.count() == lost.where("customer_id is not null").count() > 0
        plan = rejected._jdf.queryExecution().executedPlan().toString()
        assert "_apart" in next(x for x in plan.splitlines() if "hashpartitioning(customer_id" in x)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def test_catalog_domain(spark, toy):
    allowed = spark.createDataFrame([("Unico",)], "s string")
    assert rows(dq.outside_domain(toy["sizes"], SOURCES["sizes"], "size", allowed), "rule", "value") == [
        ("catalog_domain:size", "P")
    ]


def test_split_of_repeated_keys(spark):
    status = SOURCES["purchases_status"]
    schema = "purchase_id long, status string, created_at timestamp_ntz, extra int"
    day = lambda n: dt.datetime(2025, 1, n)
    data = [(1, "Sent", day(2), 1), (1, "Sent", day(1), 2), (1, "Nowhere", day(1), 3), (2, "Sent", day(1), 4), (2, "Sent", day(1), 4)]
    data += [(3, "Sent", day(1), 5), (None, "Sent", day(1), 6), (None, "Sent", day(1), 6)] + [(9, "Sent", day(5), k) for k in range(3000)]
    good, rejected = dq.split(spark.createDataFrame(data, schema), status, unique=True)
    assert rows(good, "purchase_id", "extra") == [(1, 2), (2, 4), (3, 5), (9, 0)]
    broken = rows(rejected.where("purchase_id <> 9 or purchase_id is null"), "purchase_id", "extra", "broken_rules")
    null = ["not_null:purchase_id"]
    assert broken == [(1, 1, ["primary_key"]), (1, 3, ["domain:status"]), (2, 4, ["primary_key"]), (None, 6, null), (None, 6, null)]
    assert rejected.where("purchase_id = 9").count() == 2999
    plan = rejected._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    same, none = dq.split(spark.createDataFrame(data[5:6], schema), status, unique=True)
    assert same.count() == 1 and none.count() == 0


def test_all_rules_of_a_table_take_two_scans(spark, toy):
    path = {n: work_path(spark, n) for n in ("purchases_items", "purchases", "items", "sizes", "items_sizes")}
    for n, p in path.items():
        toy[n].write.parquet(p)
    tables = {n: spark.read.parquet(p) for n, p in path.items()}
    twice = tables["purchases_items"].unionByName(tables["purchases_items"].where("purchase_id = 1"))
    found = dq.violations(tables["purchases_items"], SOURCES["purchases_items"], tables)
    assert found.count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x and "purchases_items" in x]
    assert 0 < len(scans) <= 2
    lost = {**tables, "sizes": tables["sizes"].where("id > 1"), "items_sizes": tables["items_sizes"].where("item_id <> 3")}
    got = dq.violations(twice, SOURCES["purchases_items"], lost)
    apart = [dq.duplicate_keys(twice, SOURCES["purchases_items"])]
    apart += [dq.orphans(twice, SOURCES["purchases_items"], r, lost[r.parent]) for r in SOURCES["purchases_items"].references]
    want = [r for df in apart for r in rows(df)]
    assert rows(got) == sorted(want, key=repr) and len(want) == 4
