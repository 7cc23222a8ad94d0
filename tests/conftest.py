from __future__ import annotations

import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from martloom.schema import SOURCES  # noqa: E402
from martloom.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "martloom-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def stamp(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


OLD, NEW = stamp("2025-04-20"), stamp("2025-04-23")
D = dt.date

# A hand-made source: see FIXTURES.md for the cases it holds.
TOY = {
    "categories": [(1, "Livros", OLD), (2, "Eletronicos", OLD)],
    "items": [(1, "Tablet", 2, OLD), (2, "Romance", 1, OLD), (3, "Webcam", 2, NEW)],  # 3: category older than the delta
    "sizes": [(1, "Unico", OLD), (2, "P", OLD)],
    "items_sizes": [(1, 1, OLD), (2, 1, OLD), (2, 2, OLD), (3, 1, NEW)],
    "prices": [(1, 1, Decimal("100.10"), OLD), (2, 1, Decimal("20.00"), OLD), (3, 1, Decimal("55.55"), NEW)],
    "stores": [(1, "Loja Azul", "contato@loja_azul.com.br", OLD), (2, "Ponto Certo", "x@y", OLD), (3, "Sem Lugar", "z@y", OLD)],
    "addresses": [
        (10, "Rua A", "1", None, None, "Recife", "PE", "50000-000", "Brasil", OLD),
        (11, "Rua B", "2", "Sala 2", "Centro", "Curitiba", "PR", "80000", "Brasil", OLD),
        (12, "Rua C", "3", None, None, None, "SP", "01000000", None, OLD),
    ],
    "stores_addresses": [(1, 10, OLD), (1, 11, NEW), (2, 12, OLD)],  # two addresses; store 3 has none
    "customers": [(1, "João da Silva", "joo.silva@example.com", OLD), (2, "Ana", "ana@example.com", NEW)],
    "customers_addresses": [(1, 10, OLD), (2, 12, NEW)],
    "phones": [(1, "Mobile", "11-912345678"), (2, None, "20-1234")],
    "phones_customers": [(1, 1)],
    "phones_stores": [(2, 1)],
    "purchases": [
        (1, 1, 1, D(2025, 4, 18), OLD),  # a Friday
        (2, None, 2, D(2025, 4, 19), OLD),  # guest, a Saturday
        (3, 1, 1, D(2025, 4, 18), OLD),  # no status
        (4, 2, 2, D(2025, 4, 20), NEW),  # a Sunday
        (5, 1, 1, D(2021, 1, 4), NEW),  # late date
        (6, None, 1, D(2025, 4, 18), NEW),  # date already known
    ],
    "purchases_items": [
        (1, 1, 1, 2, OLD),
        (1, 2, 1, 1, OLD),
        (2, 2, 2, 1, OLD),  # pair without price
        (2, 1, 1, 1, OLD),
        (3, 1, 1, 5, OLD),
        (4, 3, 1, 3, NEW),
        (5, 2, 1, 4, NEW),
        (6, 1, 1, 1, NEW),
    ],
    "purchases_status": [
        (1, "Sent", OLD),
        (2, "Canceled", OLD),
        (4, "Pending", NEW),
        (5, "Delivered", NEW),
        (6, "Sent", NEW),
    ],
    "inventory": [(1, 1, 1, 10, OLD), (2, 1, 2, 0, OLD), (9, 9, 1, 7, OLD)],  # the last has no catalog pair
}


@pytest.fixture(scope="session")
def toy(spark):
    return {n: spark.createDataFrame(rows, SOURCES[n].struct) for n, rows in TOY.items()}


def rows(df, *columns) -> list[tuple]:
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
