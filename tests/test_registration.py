import datetime as dt

import pytest
from conftest import D, rows

from martloom.operators.audit import LimitReached, first_n
from martloom.plans import catalog as cat
from martloom.plans.registration import basket_lines, register_customers, register_orders, register_stores
from martloom.sources.tables import JdbcSplit, jdbc_options, read_catalog_csv, read_parquet

ORDERS = (
    "order_seq long, customer_id long, store_id long, order_date date, status string, "
    "lines array<struct<item_id:long,size_id:long,quantity:int>>"
)
AT = dt.datetime(2025, 4, 22)


def test_register_orders(spark):
    orders = spark.createDataFrame(
        [
            (1, 7, 1, D(2025, 1, 1), "Sent", [(1, 1, 1), (1, 1, 2), (2, 1, 1)]),  # pair named twice; item 2 not stocked
            (2, None, 1, D(2025, 1, 2), "Pending", [(1, 1, 3)]),  # too large for what is left
            (3, None, 1, D(2025, 1, 3), "Sent", [(1, 1, 1), (9, 9, 1)]),  # fits
            (4, 8, 2, D(2025, 1, 4), "Sent", [(1, 1, 1)]),  # other store, no stock row
        ],
        ORDERS,
    )
    inventory = spark.createDataFrame(
        [(1, 1, 1, 4, AT), (3, 1, 1, 5, AT)], "item_id long, size_id long, store_id long, quantity long, created_at timestamp_ntz"
    )
    assert rows(basket_lines(orders).where("order_seq = 1"), "item_id", "quantity") == [(1, 3), (2, 1)]
    made = register_orders(orders, inventory, AT, last_id=100)
    assert rows(made["purchases"], "id", "customer_id", "order_date") == [
        (101, 7, D(2025, 1, 1)),
        (102, None, D(2025, 1, 3)),
    ]
    assert rows(made["purchases_items"], "purchase_id", "item_id", "quantity") == [(101, 1, 3), (102, 1, 1)]
    assert rows(made["purchases_status"], "purchase_id", "status") == [(101, "Sent"), (102, "Sent")]
    assert rows(made["rejected_lines"], "order_seq", "item_id", "quantity") == [(1, 2, 1), (2, 1, 3), (3, 9, 1), (4, 1, 1)]
    assert rows(made["empty_orders"]) == [(2,), (4,)]
    assert rows(made["inventory"], "item_id", "quantity") == [(1, 0), (3, 5)]
    with pytest.raises(LimitReached):
        register_orders(orders, inventory, purchases=spark.range(3), limit=3)


ADDRESS = "struct<street:string,number:string,complement:string,neighborhood:string,city:string,state:string,zip_code:string,country:string>"


def test_register_people(spark):
    place = ("Rua A", "1", None, "Centro", "Recife", "PE", "50000-000", None)
    people = spark.createDataFrame(
        [("João da Silva", place, ("Mobile", "11-912345678")), ("Ana", place, None), ("Rui Sá", place, (None, "x"))],
        f"full_name string, address {ADDRESS}, phone struct<phone_type:string,number:string>",
    )
    made = register_customers(people, ["full_name"], AT, {"customers": 10, "addresses": 20, "phones": 30})
    assert rows(made["customers"], "customer_id", "email") == [
        (11, "ana@example.com"),
        (12, "joo.silva@example.com"),
        (13, "rui.s@example.com"),
    ]
    assert rows(made["customers_addresses"], "customer_id", "address_id") == [(11, 21), (12, 22), (13, 23)]
    assert rows(made["addresses"], "id", "country") == [(21, "Brasil"), (22, "Brasil"), (23, "Brasil")]
    assert rows(made["phones_customers"]) == [(31, 12), (32, 13)]
    assert rows(made["phones"]) == [(31, "Mobile", "11-912345678"), (32, None, "x")]
    shops = register_stores(people.withColumnRenamed("full_name", "name"), ["name"], AT)
    assert rows(shops["stores"], "id", "email") == [
        (1, "contato@ana.com.br"),
        (2, "contato@jo_o_da_silva.com.br"),
        (3, "contato@rui_s.com.br"),
    ]
    assert shops["stores"].schema["created_at"].dataType.simpleString() == "timestamp_ntz"


CSV = """nome_item,categoria,tamanhos_validos
Tablet,Eletronicos,Unico
Camisa,Moda,P;M;G
Romance,Livros,Unico
Tablet,Moda,M
"""


def test_catalog_from_csv(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_text(CSV)
    catalog = read_catalog_csv(spark, str(path))
    assert rows(first_n(catalog, "position", 2), "position", "nome_item") == [(0, "Tablet"), (1, "Camisa")]
    made = cat.normalise(catalog)
    assert rows(made["categories"]) == [(1, "Eletronicos"), (2, "Moda"), (3, "Livros")]
    assert rows(made["sizes"]) == [(1, "G"), (2, "M"), (3, "P"), (4, "Unico")]
    assert rows(made["items"]) == [(1, "Tablet", 1), (2, "Camisa", 2), (3, "Romance", 3)]  # first category wins
    assert rows(made["items_sizes"]) == [(1, 2), (1, 4), (2, 1), (2, 2), (2, 3), (3, 4)]


def test_parquet_source_round_trip(spark, toy, tmp_path):
    for name, df in toy.items():
        df.write.parquet(str(tmp_path / name))
    back = read_parquet(spark, str(tmp_path))
    assert {n: rows(df) for n, df in back.items()} == {n: rows(df) for n, df in toy.items()}


def test_jdbc_options():
    # options only: a test may not start a database
    split = JdbcSplit("id", 1, 1000, 8)
    options = jdbc_options("jdbc:x", "purchases", {"user": "u"}, split)
    assert options["dbtable"] == "purchases" and options["user"] == "u" and options["preferTimestampNTZ"] == "true"
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["id", "1", "1000", "8"]
    assert "partitionColumn" not in jdbc_options("jdbc:x", "sizes")


def test_limit_needs_the_stored_purchases(spark):
    with pytest.raises(ValueError, match="limit"):
        register_orders(spark.range(0), spark.range(0), limit=3)
