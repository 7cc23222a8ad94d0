"""Mixing sources to target weights by weighted fair queueing.

Every document stands in its source's queue twice, in an order shuffled by a hash of its id. Its virtual finish time is
the number of the source's words up to and with it, divided by the source's target. All queues are merged by a global range sort on
that time and cut where the total budget is spent. Running sums are taken within hash ranges of a
source and carried over from range to range, so a source that holds a third of all rows is spread over many tasks; the
cut is one row, so what each document gives is decided row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import materialize

RANGES = 4096  # hash ranges of a source's queue: three hexadecimal digits
TIMES = 2  # a document is taken so many times at most
WEIGHTS = (3, 1, 2)  # of the sources in order, again and again
FILL = 1.5  # budget as a share of all sizes


def words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, fill: float = FILL, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, target of ``sources`` (source, source_size).

    Sources in code-point order, null last, take ``weights`` in turn and share ``fill`` of all sizes by them; a target stops
    at ``TIMES`` its source's size and what is over goes to the rest by weight. The stopped ones are
    the first by size per weight: with k stopped the others get (budget - stopped) / (weights left) per weight, and
    the right k is the first where that stays under the next one's limit. Sources without words get 0.
    One row per source passes here.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    share = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    limit = F.col("source_size") * TIMES
    by_limit = Window.orderBy((limit / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    level = (
        (F.sum("source_size").over(everything) * F.lit(fill)) - F.coalesce(F.sum(limit).over(before), F.lit(0)).cast("double")
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).cast("double")
    fits = limit.cast("double") > F.col("weight") * F.col("level")  # the first that fits, and all behind it, aren't stopped
    return (
        sources.withColumn("weight", share)
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(fits, F.struct(limit / F.col("weight"), F.col("level")))).over(everything).getField("level"))
        .select("source", "source_size", F.least(limit.cast("double"), F.coalesce(F.col("weight") * F.col("level"), limit.cast("double"))).alias("target"))
    )


def order_key() -> Column:
    """Place of a document in its source's shuffled queue, before size and id."""
    return F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))


def queue_name(source: Column) -> Column:
    """The source as a key that is never null, so that equal keys stay in one partition from step to step."""
    return F.coalesce(F.concat(F.lit("+"), source.cast("string")), F.lit("-"))


def queued(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents with size, key, target and words of their queue up to them, sizes and targets by source)."""
    sized = materialize(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), queue_name(F.col("source")).alias("queue"), words(F.col("text")).alias("size")
        ).withColumn("key", order_key()),
        "sized",
    ).withColumn("slot", F.substring("key", 1, 3))
    slots = materialize(sized.groupBy("queue", "slot").agg(F.sum("size").alias("n")), "slots")
    source = F.expr("case when queue <> '-' then substring(queue, 2) end").alias("source")
    sizes = slots.groupBy("queue").agg(F.sum("n").alias("source_size")).select(source, "source_size")
    goal = materialize(targets(sizes).withColumn("queue", queue_name(F.col("source"))), "targets")
    ahead = Window.partitionBy("queue").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        slots.withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
        .join(goal.drop("source"), "queue")
        .select("queue", "slot", "ahead", "source_size", "target")
    )
    within = Window.partitionBy("queue", "slot").orderBy("key", "size", "doc_id")  # rows that are alike count together
    placed = (
        sized.withColumn("run", F.sum("size").over(within))
        .join(carried, ["queue", "slot"])
        .select("doc_id", "queue", "size", "key", "source_size", "target", (F.col("ahead") + F.col("run")).alias("upto"))
    )
    return materialize(placed, "placed"), goal


ORDER = ("at", "key", "size", "doc_id")


def finish(turn: int) -> Column:
    """Virtual finish time of the document's turn (1, 2): words of its queue so far over the target."""
    return F.when(F.col("target") > 0, (F.col("upto") + F.col("source_size") * (turn - 1)) / F.col("target")).otherwise(F.lit(None).cast("double"))


def taken_times(docs: DataFrame) -> DataFrame:
    """Every row with doc_id, queue, key, size, source_size, target and whether each of its turns is taken (``turns``)."""
    placed, goal = queued(docs)
    budget = float(goal.agg(F.coalesce(F.sum("source_size"), F.lit(0)) * F.lit(FILL)).first()[0])
    turns = F.explode(F.array(*(F.struct(finish(t).alias("at"), F.lit(t).alias("turn")) for t in range(1, TIMES + 1)))).alias("t")
    queue = materialize(
        placed.where("target > 0 and size > 0")
        .select("key", "size", "doc_id", turns)
        .select("t.at", "key", "size", "doc_id")
        .repartitionByRange(*ORDER)
        .sortWithinPartitions(*ORDER)
        .withColumn("part", F.spark_partition_id()),
        "queue",
    )
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    parts = queue.groupBy("part").agg(F.sum("size").alias("n")).withColumn("ahead", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    torn = parts.where((F.col("ahead") <= budget) & (F.col("ahead") + F.col("n") > budget)).select("part", "ahead").first()
    last = None
    if torn is not None:  # the range in which the budget ends: one of many, its rows pass one task
        run = F.sum("size").over(Window.orderBy(*ORDER)) + torn.ahead
        inside = queue.where(F.col("part") == torn.part).withColumn("run", run).where(F.col("run") <= budget)
        before = queue.where(F.col("part") < torn.part)
        last = inside.agg(F.max(F.struct(*ORDER))).first()[0] or before.agg(F.max(F.struct(*ORDER))).first()[0]

    def taken(turn: int) -> Column:
        if torn is None:
            return F.col("size") > 0  # no more words than the budget
        if last is None:
            return F.lit(False)
        edge = F.struct(*(F.lit(last[c]).cast(kind).alias(c) for c, kind in zip(ORDER, ("double", "string", "long", "long"), strict=True)))
        return (F.col("size") > 0) & F.coalesce(F.struct(finish(turn).alias("at"), "key", "size", "doc_id") <= edge, F.lit(False))

    return placed.select("doc_id", "queue", "key", "size", "source_size", "target", F.array(*map(taken, range(1, TIMES + 1))).alias("turns"))


def mix(docs: DataFrame) -> DataFrame:
    """Every row with doc_id, size, source_size, target and taken, the words the mix takes of it.

    A null text has size 0 and gives nothing; null sources are one source, the last; null ids share one place in
    the order. Rows with the same id, source and size are taken together or not at all. An
    empty table gives no rows. A document is taken whole, 0 to 2 times. Other columns are not read.
    """
    times = F.size(F.filter("turns", lambda t: t))
    return taken_times(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))


def apply_mix(docs: DataFrame) -> DataFrame:
    """The documents the mix takes words of, as they were, with ``copies``, how often each is taken.

    What a source gives is the head of its queue, so one row for each source says where each turn ends and texts
    are not shuffled.
    """
    place = F.struct("key", "size", "doc_id")
    ends = [F.max(F.when(F.col("turns")[t], place)).alias(f"end{t}") for t in range(TIMES)]
    ends = materialize(taken_times(docs).where("size > 0").groupBy(F.col("queue").alias("_queue")).agg(*ends), "ends")
    own = F.struct(order_key().alias("key"), words(F.col("text")).alias("size"), F.col("doc_id").cast("long").alias("doc_id"))
    copies = sum((F.when(own <= F.col(f"end{t}"), 1).otherwise(0) for t in range(TIMES)), F.lit(0))
    joined = docs.join(ends, queue_name(docs["source"]) == F.col("_queue"))
    return joined.where(words(F.col("text")) > 0).withColumn("copies", copies).where("copies > 0").select(*docs.columns, "copies")


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM sums),
levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5
      - coalesce(sum(source_size * 2) OVER before, 0)::DOUBLE)
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed
  WINDOW before AS (ORDER BY (source_size * 2)::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goal AS (
  SELECT source, source_size, least(source_size * 2.0::DOUBLE, coalesce(weight * (SELECT level FROM levels
      WHERE (source_size * 2)::DOUBLE > weight * level ORDER BY (source_size * 2)::DOUBLE / weight LIMIT 1), source_size * 2.0::DOUBLE)) AS target
  FROM levels),
placed AS (
  SELECT d.*, g.source_size, g.target,
         sum(size) OVER (PARTITION BY d.source ORDER BY key, size, doc_id) AS upto
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
queue AS (
  SELECT *, (upto + source_size * (turn - 1))::DOUBLE / target AS fin
  FROM placed, (SELECT unnest([1, 2]) AS turn) WHERE target > 0 AND size > 0),
running AS (SELECT *, sum(size) OVER (ORDER BY fin, key, size, doc_id) AS run FROM queue),
given AS (
  SELECT doc_id, size, source, size * count(DISTINCT turn) AS taken FROM running
  WHERE run <= (SELECT sum(source_size) * 1.5::DOUBLE FROM sums) GROUP BY doc_id, size, source)
SELECT p.doc_id, p.size, p.source_size::BIGINT AS source_size, p.target, coalesce(g.taken, 0)::BIGINT AS taken
FROM placed p LEFT JOIN given g ON p.doc_id IS NOT DISTINCT FROM g.doc_id AND p.size = g.size AND p.source IS NOT DISTINCT FROM g.source
"""
