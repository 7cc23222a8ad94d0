"""Declared table rules as Spark jobs: violations, split into good and bad rows, strict check."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.operators.audit import union_all
from martloom.schema import TEXT, Domain, Minimum, Pattern, Table
from martloom.session import materialize

KINDS = ("not_null", "max_length", "domain", "minimum", "pattern")


class RuleViolation(RuntimeError):
    """Rows break a declared rule."""


def _row_rules(table: Table, kinds=KINDS) -> list[tuple[str, str, Column]]:
    """(rule, column, broken) for every rule that a single row can break; null passes all but not_null."""
    rules = []
    for c in table.columns:
        if "not_null" in kinds and not c.nullable:
            rules.append((f"not_null:{c.name}", c.name, F.col(c.name).isNull()))
        if "max_length" in kinds and c.type == TEXT and c.length:
            rules.append((f"max_length:{c.name}", c.name, F.length(c.name) > c.length))
    for check in table.checks:
        value = F.col(check.column)
        if isinstance(check, Domain) and "domain" in kinds:
            rules.append((f"domain:{check.column}", check.column, ~value.isin(*check.values)))
        elif isinstance(check, Minimum) and "minimum" in kinds:
            broken = value <= check.bound if check.strict else value < check.bound
            rules.append((f"minimum:{check.column}", check.column, broken))
        elif isinstance(check, Pattern) and "pattern" in kinds:
            rules.append((f"pattern:{check.column}", check.column, ~value.rlike(check.regex)))
    return [(name, column, F.coalesce(broken, F.lit(False))) for name, column, broken in rules]


def key_text(columns) -> Column:
    return F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def _violation(table: Table, rule: Column, key: Column, value: Column, rows: Column) -> list[Column]:
    return [
        F.lit(table.name).alias("table_name"),
        rule.alias("rule"),
        key.alias("key"),
        value.alias("value"),
        rows.cast("bigint").alias("n_rows"),
    ]


def row_violations(df: DataFrame, table: Table, kinds=KINDS) -> DataFrame:
    """All single-row rules in one pass over the table, one output row per broken rule."""
    broken = F.array(
        *(
            F.when(
                bad,
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.col(column).cast("string").alias("value"),
                ),
            )
            for rule, column, bad in _row_rules(table, kinds)
        )
    )
    return df.select(key_text(table.key).alias("key"), F.explode(F.array_compact(broken)).alias("v")).select(
        *_violation(table, F.col("v.rule"), F.col("key"), F.col("v.value"), F.lit(1))
    )


def duplicate_keys(df: DataFrame, table: Table, columns=None) -> DataFrame:
    """Keys held by more than one row. Counted per task first, so a hot key moves as one row."""
    columns = list(columns or table.key)
    rule = "primary_key" if columns == list(table.key) else "unique:" + ",".join(columns)
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > 1)
        .select(*_violation(table, F.lit(rule), key_text(columns), key_text(columns), F.col("_rows")))
    )


def orphans(df: DataFrame, table: Table, reference, parent: DataFrame) -> DataFrame:
    """Foreign keys without parent, one row per key with the number of child rows; null keys pass."""
    columns = list(reference.columns)
    parent_keys = parent.select(
        *(F.col(p).alias(c) for c, p in zip(columns, reference.parent_columns, strict=True))
    )
    rule = f"foreign_key:{','.join(columns)}->{reference.parent}"
    return (
        df.dropna("any", subset=columns)
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .join(parent_keys, columns, "left_anti")
        .select(*_violation(table, F.lit(rule), key_text(columns), key_text(columns), F.col("_rows")))
    )


def outside_domain(df: DataFrame, table: Table, column: str, allowed: DataFrame) -> DataFrame:
    """Values of ``column`` that a data-driven domain (a one-column frame) does not list."""
    return (
        df.dropna("any", subset=[column])
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .join(allowed.toDF(column), column, "left_anti")
        .select(
            *_violation(
                table, F.lit(f"catalog_domain:{column}"), F.col(column), F.col(column), F.col("_rows")
            )
        )
    )


def key_violations(df: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Keys held twice and foreign keys without parent, of all keys and references of a table in one scan and one shuffle.

    Each row gives its value of every key and reference, as texts; values are counted per task before they move,
    and meet the keys of all parents in one join. A null in a reference passes.
    """
    unique = [table.key, *table.unique]
    references = [r for r in table.references if r.parent in (parents or {})]
    names = ["primary_key", *("unique:" + ",".join(u) for u in table.unique)]
    names += [f"foreign_key:{','.join(r.columns)}->{r.parent}" for r in references]

    def entry(rule: int, columns) -> Column:
        return F.struct(F.lit(rule).alias("_rule"), F.array(*(c.cast("string") for c in columns)).alias("_key"))

    entries = [entry(i, map(F.col, columns)) for i, columns in enumerate(unique)]
    known = []
    for i, r in enumerate(references, len(unique)):
        given = reduce(and_, (F.col(c).isNotNull() for c in r.columns))
        entries.append(F.when(given, entry(i, map(F.col, r.columns))))
        # in the child's type, so that equal keys are equal texts
        own = (F.col(p).try_cast(df.schema[c].dataType) for c, p in zip(r.columns, r.parent_columns, strict=True))
        known.append(parents[r.parent].select(entry(i, own).alias("e")).select("e.*"))
    counted = (
        df.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy("e._rule", "e._key").agg(F.count(F.lit(1)).alias("_rows"))
    )
    if known:
        counted = counted.join(reduce(DataFrame.unionByName, known).distinct().withColumn("_found", F.lit(True)), ["_rule", "_key"], "left")
    else:
        counted = counted.withColumn("_found", F.lit(None).cast("boolean"))
    repeated = (F.col("_rule") < len(unique)) & (F.col("_rows") > 1)
    lost = (F.col("_rule") >= len(unique)) & F.col("_found").isNull()
    rule = F.element_at(F.array(*map(F.lit, names)), F.col("_rule") + 1)
    key = F.array_join("_key", "|", "")
    return counted.where(repeated | lost).select(*_violation(table, rule, key, key, F.col("_rows")))


def violations(df: DataFrame, table: Table, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Every broken rule of one table: (table_name, rule, key, value, n_rows).

    Foreign keys are checked against the ``parents`` given. The table is scanned twice, whatever its rules.
    """
    return union_all([row_violations(df, table), key_violations(df, table, parents)])


def check(tables: Mapping[str, DataFrame], declared: Mapping[str, Table]) -> DataFrame:
    """Every broken rule of every table."""
    return union_all([violations(df, declared[name], tables) for name, df in tables.items()])


def enforce(found: DataFrame) -> None:
    """Raise when there are violations, naming the first few."""
    some = found.take(5)
    if some:
        raise RuleViolation("; ".join(f"{v.table_name} {v.rule} {v.key}" for v in some))


def split_repeats(df: DataFrame, table: Table, columns=None) -> tuple[DataFrame, DataFrame]:
    """(rows to keep, repeats): of the rows of one key the first by all their other columns stays.

    Keys held twice are found by partial counts and stored, so that the joins that part their rows from the others see
    plain exchanges and split a hot key. Only those rows are written down, each with a number, by which equal rows are
    told apart; no row is ranked. Keys with a null are not compared (a rule of their own).
    """
    columns = list(columns or table.key)
    rest = [c for c in df.columns if c not in columns]
    named = df.dropna("any", subset=columns)
    twice = materialize(named.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(*columns), "repeated-keys")
    if twice.isEmpty():
        return df, df.where(F.lit(False))
    held = materialize(named.join(twice, columns, "left_semi").select(*df.columns).withColumn("_row", F.monotonically_increasing_id()), "repeats")
    first = held.groupBy(*columns).agg(F.min(F.struct(*rest, "_row")).getField("_row").alias("_row")).select("_row")
    first = materialize(first, "first-rows")
    alone = df.join(twice, columns, "left_anti").select(*df.columns)
    stay = held.join(first, "_row", "left_semi").select(*df.columns)
    return alone.unionByName(stay), held.join(first, "_row", "left_anti").select(*df.columns)


def split(df: DataFrame, table: Table, tables: Mapping[str, DataFrame] | None = None, unique: bool = False):
    """(good, rejected) rows; rejected rows carry the broken rules in ``broken_rules``.

    Covers single-row rules and, for the parents given, foreign keys. With ``unique`` also keys held twice, among the
    rows that break no other rule: the first row of a key stays (see ``split_repeats``).
    """
    tables = tables or {}
    broken = [F.when(bad, F.lit(rule)) for rule, _, bad in _row_rules(table)]
    judged = df
    for i, r in enumerate(r for r in table.references if r.parent in tables):
        columns, flag = list(r.columns), f"_parent_{i}"
        parent = tables[r.parent].select(
            *(F.col(p).alias(c) for c, p in zip(columns, r.parent_columns, strict=True))
        )
        given = F.lit(True)
        for c in columns:
            given = given & F.col(c).isNotNull()
        # rows without a key find no parent; a hash of their own key spreads them over all partitions
        apart = F.when(given, F.xxhash64(*columns)).otherwise(F.xxhash64(*table.key))
        same = F.xxhash64(*(F.col(c).try_cast(df.schema[c].dataType) for c in columns))
        judged = (
            judged.withColumn("_apart", apart)
            .join(parent.distinct().withColumns({flag: F.lit(True), "_apart": same}), [*columns, "_apart"], "left")
            .drop("_apart")
        )
        broken.append(
            F.when(given & F.col(flag).isNull(), F.lit(f"foreign_key:{','.join(columns)}->{r.parent}"))
        )
    judged = judged.select(*df.columns, F.array_compact(F.array(*broken)).alias("broken_rules"))
    good = judged.where(F.size("broken_rules") == 0).drop("broken_rules")
    rejected = judged.where(F.size("broken_rules") > 0)
    for columns in [table.key, *table.unique] if unique else []:
        rule = "primary_key" if columns == table.key else "unique:" + ",".join(columns)
        good, repeats = split_repeats(good, table, columns)
        rejected = rejected.unionByName(repeats.withColumn("broken_rules", F.array(F.lit(rule))))
    return good, rejected
