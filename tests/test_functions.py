import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from martloom.functions import calendar as cal
from martloom.functions import text as tx
from martloom.schema import PHONE_PATTERN, REGIONS, STATE_REGIONS, ZIP_PATTERN


def apply(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


CUSTOMERS = {
    "João da Silva": "joo.silva@example.com",
    "Ana": "ana@example.com",
    "Maria DOS Santos de Souza": "maria.souza@example.com",
    "  Ana \t Lima\n": "ana.lima@example.com",
    "Ana Lima": "ana.lima@example.com",
    "da de": None,
    "   ": None,
    "": None,
    None: None,
    "123": "@example.com",
    "Dr. Élio d'Ávila": "dr.dvila@example.com",
}


def test_customer_email(spark):
    assert apply(spark, list(CUSTOMERS), tx.customer_email) == list(CUSTOMERS.values())


STORES = {
    "Loja Azul": "contato@loja_azul.com.br",
    "  Ponto -- Certo!": "contato@ponto_certo.com.br",
    "Loja nº 1": "contato@loja_n_1.com.br",
    "_x_": "contato@x.com.br",
    "---": None,
    "": None,
    None: None,
}


def test_store_email(spark):
    assert apply(spark, list(STORES), tx.store_email) == list(STORES.values())


def test_normalize_name(spark):
    assert apply(spark, ["Ação 7!", "ÀB", None], tx.normalize_name) == ["ao", "b", None]


def test_region(spark):
    assert apply(spark, ["SP", "PE", "XX", None], tx.region_of) == ["Sudeste", "Nordeste", None, None]
    assert len(STATE_REGIONS) == 27 and set(STATE_REGIONS.values()) == set(REGIONS)


def test_parse_date(spark):
    got = apply(spark, ["2025-02-28", "2025-02-30", "x", None], cal.parse_date)
    assert got == [dt.date(2025, 2, 28), None, None, None]


@pytest.mark.parametrize("day,weekend", [(18, False), (19, True), (20, True), (21, False)])
def test_calendar(spark, day, weekend):
    row = spark.range(1).select(*cal.calendar_parts(F.lit(dt.date(2025, 4, day)))).first()
    assert tuple(row) == (day, 4, 2, 2025, weekend)


def test_zones(spark):
    stamp = F.lit(dt.datetime(2025, 4, 22)).cast("timestamp_ntz")
    row = spark.range(1).select(
        cal.stamp_text(cal.local_to_utc(stamp)).alias("u"), cal.stamp_text(cal.utc_to_local(stamp)).alias("l")
    )
    assert tuple(row.first()) == ("2025-04-22 03:00:00", "2025-04-21 21:00:00")


def test_nan_to_null(spark):
    assert apply(spark, [1.0, float("nan"), None], tx.nan_to_null, "double") == [1, None, None]


def test_patterns(spark):
    zips = {"01000-000": True, "01000000": True, "01000": True, "0100-000": False, "01000-00": False, "01000\n": False}
    assert apply(spark, list(zips), lambda c: c.rlike(ZIP_PATTERN)) == list(zips.values())
    phones = {
        "11-912345678": True,
        "(11) 91234-5678": True,
        "1112345678": True,
        "20-912345678": False,
        "5,12345678": False,
        "72-912345678": False,
        "11-9123": False,
        "11-912345678\n": False,
    }
    assert apply(spark, list(phones), lambda c: c.rlike(PHONE_PATTERN)) == list(phones.values())


def test_area_codes():
    valid = {f"{n}" for n in range(10, 100) if re.match(PHONE_PATTERN.replace(r"\z", r"\Z"), f"{n}-912345678")}
    missing = {"20", "25", "26", "29", "23"} - {"23"} | {"30", "39", "40", "50", "52", "56", "57", "58", "59", "60"}
    missing |= {"70", "72", "76", "78", "80", "90", "10"}
    assert valid == {f"{n}" for n in range(10, 100)} - missing


def random_names(n=3000):
    import random

    rng = random.Random(3)
    letters = "abcxyzABCXYZÁÉÍÓÚãõçÇñßİıKΣσς0189-_.'’"
    blanks = " \t\n\r\x0b\x0c\x1c\x1f\x85     　"
    words = ["da", "DE", "Dos", "das", "d", "dá"]
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            word = rng.choice(words) if rng.random() < 0.3 else "".join(rng.choices(letters, k=rng.randint(1, 6)))
            parts += [word, "".join(rng.choices(blanks, k=rng.randint(1, 2)))]
        yield "".join(rng.choices(blanks, k=rng.randint(0, 1)) + parts)


def a_to_z(text):
    return "".join(c for c in text.lower() if "a" <= c <= "z")


def expected_customer_email(name):
    words = [w for w in name.split() if w.lower() not in {"da", "de", "dos", "das"}]
    if not words:
        return None
    return ".".join(a_to_z(w) for w in ([words[0], words[-1]] if len(words) > 1 else words)) + "@example.com"


def expected_store_email(name):
    kept = "".join(c if c.isascii() and c.isalnum() else " " for c in name.lower()).split()
    return f"contato@{'_'.join(kept)}.com.br" if kept else None


def test_emails_of_random_names(spark):
    names = list(random_names())
    assert apply(spark, names, tx.customer_email) == [expected_customer_email(n) for n in names]
    assert apply(spark, names, tx.store_email) == [expected_store_email(n) for n in names]
