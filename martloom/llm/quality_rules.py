"""Quality rules over whole texts, as a cascade that stops at the first rule a text fails.

What a rule costs and how many texts it rejects is measured on a sample of SAMPLE texts; the rules are
then tried in the order of texts rejected per second, so that dear rules see only what cheap ones let
pass. The order decides the work, never the verdict: a text is kept if no rule fails.

Everything is SQL functions over one row at a time; nothing is shuffled but the sample. Three-word windows
are compared by 64-bit hashes within a text.
"""

from __future__ import annotations

import re
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import materialize

SAMPLE = 2000  # texts that order the rules; they decide nothing else
RUNS = 2  # timings of a rule, of which the shortest counts
TEXT = "coalesce(text, '')"
BLANK = "[\\\\x20\\\\x09-\\\\x0D]"  # inside an SQL literal
WORDS = f"array_remove(split({TEXT}, '{BLANK}+', -1), '')"
LINES = f"filter(split({TEXT}, '\\n', -1), x -> x rlike '[^\\\\x20\\\\x09-\\\\x0D]')"

# Words in three-word windows found twice or more, of words w: windows in the order of hash and place, places of
# equal neighbours, then up to three words for each place. A one-element array binds a value once.
REPEATED = """
transform(array(if(size(w) < 4, cast(array() as array<bigint>), transform(slice(w, 1, greatest(size(w) - 2, 0)), (x, i) -> xxhash64(x, w[i + 1], w[i + 2])))), h ->
  if(size(array_distinct(h)) = size(h), 0L,
    transform(array(sort_array(transform(h, (x, i) -> named_struct('h', x, 'i', i)))), s ->
      transform(array(sort_array(transform(
          filter(s, (x, k) -> (k > 0 and s[greatest(k - 1, 0)].h = x.h) or (k + 1 < size(s) and s[least(k + 1, size(s) - 1)].h = x.h)), x -> x.i))), p ->
        aggregate(transform(p, (x, k) -> if(k + 1 < size(p), least(3, p[least(k + 1, size(p) - 1)] - x), 3)), 0L, (sum, x) -> sum + x)
      )[0])[0]))[0]
"""

MEASURES: dict[str, str] = {
    "n_words": f"size({WORDS})",
    "word_chars": f"length({TEXT}) - regexp_count({TEXT}, '{BLANK}')",
    "n_symbols": f"regexp_count({TEXT}, '[#*$%&|<>]')",
    "n_dup_lines": f"transform(array({LINES}), l -> size(l) - size(array_distinct(l)))[0]",
    "n_repeat_words": f"transform(array({WORDS}), w -> {REPEATED})[0]",
    "n_lines": f"size({LINES})",
    "n_capitals": f"regexp_count({TEXT}, '[A-Z]')",
    "n_exclaims": f"regexp_count({TEXT}, '!')",
    "n_lettered": f"size(filter({WORDS}, x -> x rlike '[A-Za-z]|[^\\\\x00-\\\\x7F]'))",
    "n_bullets": f"size(filter({LINES}, x -> x rlike '^{BLANK}*[-*•]'))",
    "n_ellipses": f"size(filter({LINES}, x -> x rlike '([.][.][.]|…){BLANK}*$'))",
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A text fails when ``fails``, an SQL condition over ``measures``, holds."""

    name: str
    fails: str
    measures: tuple[str, ...]


# the same text is SQL for Spark and for the statement below
RULES = (
    Rule("few_words", "n_words < 50", ("n_words",)),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words", ("n_repeat_words", "n_words")),
    Rule("symbols", "100 * n_symbols > 10 * n_words", ("n_symbols", "n_words")),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words", ("word_chars", "n_words")),
    Rule("repeated_lines", "n_lines > 9 AND 100 * n_dup_lines > 30 * n_lines", ("n_dup_lines", "n_lines")),
    Rule("capitals", "100 * n_capitals > 40 * word_chars", ("n_capitals", "word_chars")),
    Rule("exclaims", "100 * n_exclaims > 30 * n_words", ("n_exclaims", "n_words")),
    Rule("letters", "100 * n_lettered < 70 * n_words", ("n_lettered", "n_words")),
    Rule("bullets", "100 * n_bullets > 90 * n_lines", ("n_bullets", "n_lines")),
    Rule("ellipses", "100 * n_ellipses > 30 * n_lines", ("n_ellipses", "n_lines")),
)
BASE_RULES = RULES[:2]


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measures as long columns, which replace columns of the same names; the words are taken once."""
    words = F.expr(f"transform(array({WORDS}), w -> named_struct('n_words', size(w), 'n_repeat_words', {REPEATED}))[0]")
    shared = docs.withColumn("_words", words)
    values = {m: F.col(f"_words.{m}") if m in ("n_words", "n_repeat_words") else F.expr(MEASURES[m]) for m in BASE}
    return shared.withColumns({m: value.cast("long") for m, value in values.items()}).drop("_words")


def fails(rule: Rule, known: Mapping[str, str]) -> Column:
    """Whether a row fails; a measure that is no column yet (``known``: measure to column) is taken from the text there and then."""
    fields = ", ".join(f"'{m}', cast({known.get(m) or MEASURES[m]} as bigint)" for m in rule.measures)
    condition = re.sub("|".join(rule.measures), lambda m: f"v.{m[0]}", rule.fails)
    return F.expr(f"transform(array(named_struct({fields})), v -> {condition})[0]")


def order(sample: DataFrame, rules: Sequence[Rule], known: Mapping[str, str]) -> list[Rule]:
    """``rules`` by rejected texts per second, most first, as measured on ``sample``; ties keep their place."""
    rows = max(sample.count(), 1)

    def timed(rule: Column) -> tuple[float, int]:
        best, failed = float("inf"), 0
        for _ in range(RUNS):
            began = time.perf_counter()
            failed = sample.agg(F.count_if(rule)).first()[0]
            best = min(best, time.perf_counter() - began)
        return best, failed

    idle, _ = timed(F.length("text") < 0)
    gain = {}
    for rule in rules:
        seconds, failed = timed(fails(rule, known))
        # a share of the time of a plain scan is the least that can be told apart
        gain[rule.name] = (failed / rows) / max(seconds - idle, idle / 20)
    return sorted(rules, key=lambda r: -gain[r.name])


def cascade(rules: Sequence[Rule], known: Mapping[str, str]) -> Column:
    """Name of the first of ``rules``, in this order, that a row fails; later rules are not evaluated. Null: none."""
    first = F.lit(None).cast("string")
    for rule in reversed(rules):
        first = F.when(fails(rule, known), F.lit(rule.name)).otherwise(first)
    return first


def sample_of(docs: DataFrame, size: int = SAMPLE) -> DataFrame:
    """About ``size`` rows from all parts of ``docs``, stored."""
    rows = docs.count()
    return materialize(docs.sample(min(1.0, size / max(rows, 1)), 7).repartition(8), "rules-sample")


def judge(
    docs: DataFrame, rules: Sequence[Rule] = RULES, known: Mapping[str, str] | None = None, sample: DataFrame | None = None
) -> DataFrame:
    """``docs`` with ``rejected_by``, the first rule of the cascade that rejects the text, null for texts to keep.

    Rows are judged by their whole ``text`` alone: null and empty texts fail for their few words, repeated
    rows and null ids are judged like any other, other columns pass through (``rejected_by`` is replaced).
    ``sample``: texts and known columns to measure the rules on, if not some of ``docs``. Of an empty table nothing is measured and the rules keep their order. Which rule is named depends on
    the measured order; whether one is named does not.
    """
    known = known or {}
    if sample is None:
        sample = sample_of(docs.select("text", *known.values()))
    return docs.withColumn("rejected_by", cascade(order(sample, rules, known), known))


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that no rule rejects."""
    return judge(docs, rules).where("rejected_by is null").select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the base measures, ``base_failed`` and ``kept`` of every row; see ``judge``."""
    own = docs.select("doc_id", "text")
    # measured behind the sampling, or every text would be measured to order the rules
    sample = materialize(measured(sample_of(own)), "rules-sample")
    judged = judge(measured(own), RULES, {m: m for m in BASE}, sample)
    failed = F.expr(" or ".join(f"({r.fails})" for r in BASE_RULES))
    return judged.select("doc_id", *BASE, failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
windows AS (
  SELECT k, i, count(*) OVER (PARTITION BY k, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS times
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) > 2)),
repeated AS (
  SELECT k, count(DISTINCT i + j) AS n FROM windows, (SELECT unnest([0, 1, 2]) AS j) WHERE times > 1 GROUP BY k),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
    length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_lettered,
    len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullets,
    len(list_filter(l, lambda x: regexp_matches(x, '([.][.][.]|…)[\x20\x09-\x0D]*$'))) AS n_ellipses
  FROM d LEFT JOIN repeated USING (k))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {" OR ".join(f"({r.fails})" for r in BASE_RULES)} AS base_failed,
  NOT ({" OR ".join(f"({r.fails})" for r in RULES)}) AS kept
FROM m
"""
