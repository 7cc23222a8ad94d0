"""Query registry: a Spark function and the DuckDB statement that must agree with it."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from martloom.session import materialize, prepare
from martloom.sources import testdata
from registry.views import VIEWS

LOW = dt.datetime(2001, 1, 1)  # mark between the full and the incremental load
HIGH = dt.datetime(2025, 6, 30)
FIRST_SNAPSHOT = dt.date(2001, 1, 1)
SNAPSHOT = dt.date(2025, 6, 30)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Inputs:
    """Adapter views and raw tables of one scale factor, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return testdata.view(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return testdata.raw(self.spark, self.sf_dir, name)

    def bundle(self, *names: str) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in names}

    def keep(self, *names: str) -> None:
        """Write these views once, for queries that read them several times; from then on they are read from there."""
        for n in names:
            setattr(self, n, materialize(getattr(self, n), n))


def _used(text: str) -> list[str]:
    return [v for v in VIEWS if re.search(rf"\b{v}\b", text)]


def with_views(body: str) -> str:
    """Put the views a statement refers to, directly or through others, in front of it."""
    body = body.strip()
    needed, todo = set(), _used(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _used(VIEWS[name])
    parts = [f"{v} AS ({VIEWS[v].strip()})" for v in VIEWS if v in needed]
    head = "WITH "
    for keyword in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(keyword):
            head, body = keyword, body[len(keyword) :]
            return head + ",\n".join([*parts, body])
    return (head + ",\n".join(parts) + "\n" if parts else "") + body


def query(name: str, sql: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str, fn=fn) -> DataFrame:
            return fn(Inputs(prepare(spark), sf_dir))

        QUERIES[name] = partial(run)
        if sql:
            ORACLE[name] = with_views(sql)
        return fn

    return register
