"""Stretches of words that repeat with a period, found as maximal pairs in LCP-interval trees.

A run is a stretch of consecutive words with smallest period q whose length is at least
``max(LEAST, TIMES * q)`` and which no neighbouring word extends with that period. Two places i and
j = i + q whose continuations agree for exactly l words and whose words in front differ (a maximal
pair) are such a run of length q + l as soon as l >= max(LEAST - q, (TIMES - 1) * q), so runs are
read off the suffix tree and never extended by hand:

* Suffixes are ordered by prefix doubling over word numbers, in numpy, for many texts at once. Word
  numbers are a text's own, so that texts never match each other, and suffixes drop out as soon as
  no other shares their first words.
* Longest common prefixes come from one pass in text order (exact, word by word).
* LCP intervals are closed from the deepest up. Each holds its places in order and the class of words
  on their left; where all places of the children have the same word on the left, no pair is maximal
  and lists are only merged. Else each place that joins is compared with its neighbours: if w stands
  at i, k and i + q with l >= 3q, then w has period gcd(k - i, q), so a place in between would make
  a smaller period. Only neighbouring places count, and no pairs of a whole class are made.

Each text is handled by itself in the task that reads it; nothing is shuffled.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import byte_pieces, small_batches

LEAST = 6  # words of the shortest run
TIMES = 4  # periods of the shortest run
SEED = 4  # suffixes that share fewer first words than this with another are in no run's pair
BLANK = "[\\x20\\x09-\\x0D]+"

RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False
)


def _order(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes sharing SEED words with another one, in suffix order; for each a bound on what it shares
    and the distance to the nearest suffix that shares SEED words."""
    n = len(codes)
    counts = np.bincount(codes)
    rank = (np.cumsum(counts) - counts)[codes]
    held = np.flatnonzero(counts[codes] > 1)  # in text order
    seeds, bound, near = np.empty(0, np.int64), np.full(n, 1, np.int64), np.empty(0, np.int64)
    h = 1
    while len(held):
        # a window shared with another place holds no separator, so held + h lies inside
        key = rank[held] * n + rank[held + h]
        at = np.argsort(key, kind="stable")
        key, held = key[at], held[at]
        first = np.concatenate([[True], key[1:] != key[:-1]])
        old = rank[held]
        group = np.concatenate([[True], old[1:] != old[:-1]])
        index = np.arange(len(held))
        rank[held] = old + np.maximum.accumulate(np.where(first, index, 0)) - np.maximum.accumulate(np.where(group, index, 0))
        alone = first & np.concatenate([first[1:], [True]])
        bound[held[alone]] = 2 * h - 1
        h *= 2
        if h == SEED:
            gap = np.where(first[1:], n, np.diff(held))  # places of a class stand in text order
            near = np.minimum(np.concatenate([[n], gap]), np.concatenate([gap, [n]]))[~alone]
            seeds = held[~alone]
        held = np.sort(held[~alone])
    final = np.argsort(rank[seeds], kind="stable")
    return seeds[final], bound[seeds[final]], near[final]


def _common(codes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Words each suffix shares with the one before it in ``order``; under SEED counts as 0."""
    out = np.zeros(len(order), np.int64)
    if not len(order):
        return out
    before = np.concatenate([[-1], order[:-1]])
    by_text = np.argsort(order, kind="stable")
    word = memoryview(codes)
    h, last = 0, -2
    shared = []
    for i, j in zip(order[by_text].tolist(), before[by_text].tolist(), strict=True):
        # the suffix one word on shares one word less at least, if it shared enough to be in the order
        h = h - 1 if i == last + 1 and h > SEED else 0
        if j < 0:
            h = 0
        else:
            while word[i + h] == word[j + h]:  # separators are all different
                h += 1
        shared.append(h)
        last = i
    out[by_text] = shared
    out[out < SEED] = 0
    return out


def _pairs(codes: np.ndarray, order: np.ndarray, shared: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of the maximal pairs that are runs."""
    least = LEAST - 1  # a pair at distance 1 shares the least
    left = codes[order - 1].tolist()
    found: list[tuple[int, int, int]] = []

    def close(depth: int, children: list) -> tuple[list[int], object]:
        children.sort(key=lambda c: len(c[0]))
        places, side = children.pop()
        mixed = side is None or any(c[1] != side for c in children)
        joined = [x for c in children for x in c[0]]
        if len(joined) < 16:
            for x in joined:
                insort(places, x)
        else:
            places.extend(joined)
            places.sort()
        if not mixed:
            return places, side
        child = {x: k for k, c in enumerate(children) for x in c[0]}
        reach = depth // (TIMES - 1)
        for x in joined:
            at = bisect_left(places, x)
            for i, j in ((at - 1, at), (at, at + 1)):
                if i < 0 or j == len(places):
                    continue
                a, b = places[i], places[j]
                q = b - a
                if q <= reach and q + depth >= LEAST and child.get(a, -1) != child.get(b, -1) and codes[a - 1] != codes[b - 1]:
                    found.append((a, q + depth, q))
        return places, None

    stack: list[tuple[int, list]] = []
    last = None
    for place, side, depth in zip(order.tolist(), left, shared.tolist(), strict=True):
        depth = depth if depth >= least else 0
        while stack and stack[-1][0] > depth:
            level, children = stack.pop()
            children.append(last)
            last = close(level, children)
        if depth:
            if stack and stack[-1][0] == depth:
                stack[-1][1].append(last)
            else:
                stack.append((depth, [last]))
        last = ([place], side)
    while stack:
        level, children = stack.pop()
        children.append(last)
        last = close(level, children)
    # a multiple of the smallest period spans the same words: the smallest stays
    best: dict[tuple[int, int], int] = {}
    for start, length, q in found:
        best[start, length] = min(q, best.get((start, length), q))
    for (start, length), q in best.items():
        yield start, length, q


def find(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each list of words, by start, then period."""
    codes = np.empty(sum(map(len, texts)) + len(texts) + 1, np.int64)
    bounds, at, fresh = [], 1, 1
    codes[0] = 0
    for words in texts:
        number: dict = defaultdict(count(fresh).__next__)
        codes[at : at + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        bounds.append(at)
        at += len(words)
        fresh += len(number)
        codes[at] = fresh  # a separator of its own
        at, fresh = at + 1, fresh + 1
    order, bound, near = _order(codes)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if (bound >= np.maximum(LEAST - 1, (TIMES - 1) * near)).any():
        shared = _common(codes, order)
        # a suffix whose best match is shorter than its nearest copy asks for is in no pair
        best = np.maximum(shared, np.concatenate([shared[1:], [0]]))
        keep = np.flatnonzero(best >= np.maximum(LEAST - 1, (TIMES - 1) * near))
        if len(keep):
            # what neighbours share once those between them are gone is the least on the way
            starts = np.concatenate([[0], keep[:-1] + 1])
            least = np.minimum.reduceat(shared[: keep[-1] + 1], starts)
            for start, length, q in _pairs(codes, order[keep], least):
                k = int(np.searchsorted(bounds, start, "right")) - 1
                out[k].append((start - bounds[k], length, q))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def kept(words: list, runs: list[tuple[int, int, int]]) -> list:
    """Words outside every run, and those of each run's first period that no other run drops."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        edge[start + q] += 1
        edge[start + length] -= 1
    return list(compress(words, (np.cumsum(edge[:-1]) == 0).tolist()))


def _arrays(found: list[list[tuple[int, int, int]]]) -> pa.ListArray:
    flat = np.array([r for runs in found for r in runs], np.int64).reshape(-1, 3)
    inner = pa.StructArray.from_arrays(
        [pa.array(flat[:, k]) for k in range(3)],
        fields=[pa.field(n, pa.int64(), False) for n in ("start", "length", "period")],
    )
    offsets = np.cumsum([0] + [len(r) for r in found]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), inner)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for part, texts in byte_pieces(whole):
            words = [t.split() for t in texts]  # of bytes: blank is \x20 and \x09-\x0D
            found = find(words)
            collapsed = [b" ".join(kept(w, r)) for w, r in zip(words, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), _arrays(found), pa.array(collapsed, pa.binary()).cast(pa.string())],
                names=["doc_id", "runs", "collapsed"],
            )


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id, ``runs`` (start, length, period; by start, then period) and ``collapsed`` text of every row of ``docs``.

    ``collapsed`` holds the words ``[^\\x20\\x09-\\x0D]+`` that no run drops, joined by one space. A run
    drops its words behind its first period. Null, empty and blank texts have no run and collapse to "";
    repeated rows and null ids each give a row of their own; other columns are not read; an empty table
    gives an empty result. A very long text is handled whole, in memory in proportion to its words.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("runs", RUNS, False), T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(_batches, schema)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` with periodic endings in every tenth text, by the checksum of its id.

    With h the crc32 of the decimal id and g = h div 10, a text of n > 0 words with h mod 10 = 0 repeats from
    word a = g mod n the p = 1 + (n - a) div (3 + g mod 8) words found there. Other texts stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    word = "array_remove(split(coalesce(text, ''), '" + BLANK.replace("\\", "\\\\") + "', -1), '')"
    # a one-element array binds the words and the numbers once
    ending = F.expr(
        f"""transform(array({word}), w -> transform(array(named_struct('n', size(w), 'g', crc32(cast(cast(doc_id as string) as binary)) div 10)), s ->
            transform(array(named_struct('a', if(s.n = 0, 0, cast(s.g % greatest(s.n, 1) as int)))), t ->
              array_join(transform(w, (x, i) -> if(i < t.a, x, element_at(w, cast(t.a + (i - t.a) % (1 + (s.n - t.a) div (3 + s.g % 8)) as int) + 1))), ' ')
            )[0])[0])[0]"""
    )
    return docs.select("doc_id", F.when(h % 10 == 0, ending).otherwise(F.col("text")).alias("text"))


def report(docs: DataFrame) -> DataFrame:
    """Runs of each text with planted periods: their number, the one of most periods, checksums of all and of the collapsed text."""
    found = collapse(with_planted_periods(docs))
    more = "x.length * best.period > best.length * x.period"
    best = F.expr(
        f"aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (best, x) -> if(best is null or {more}, x, best))"
    )
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    return found.select("doc_id", "runs", "collapsed", best.alias("top")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
