"""Exact top-k by inner product over a bit-sliced index.

Vectors become integers, floor(256 x). For a block of rows each component is stored as bit slices: one bitmap over the rows for each
binary digit. A query's scores over the block are added up slice by slice with carry bitmaps, many queries at a time;
a negative factor adds the complement of a component instead. The k best rows are then selected from the most
significant slice downward, and where rows tie at the boundary the smaller ids win.

Queries meet all rows block against block. An index block holds ``BLOCK`` rows and a query block ``QUERIES`` vectors, so a task's
memory is bounded; the k best of each block are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.common import small_batches
from martloom.session import materialize

BLOCK, QUERIES, TOGETHER = 8192, 512, 32  # rows of an index block, of a query block, queries added at a time
LARGEST = 1 << 24  # largest absolute integer component


def quantise(vectors: DataFrame, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, v): components as integers floor(256 x), x as double.

    Rows without an id, null vectors and those with a null, infinite or NaN component are left out.
    """
    x = F.col(column).cast("array<double>")
    good = F.coalesce(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))), F.lit(False))
    v = F.transform(x, lambda e: F.when(F.abs(e) * 256 < LARGEST, F.floor(e * 256)).otherwise(F.raise_error(F.lit("component out of range"))))
    return vectors.where(good & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), v.cast("array<int>").alias("v"))


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of integers; shorter vectors end in zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for k, v in enumerate(vectors):
        out[k, : len(v)] = v
    return out


def _pack(bits: np.ndarray) -> np.ndarray:
    """Booleans over rows as a bitmap of 64-bit words."""
    raw = np.packbits(bits, bitorder="little")
    return np.concatenate([raw, np.zeros(-len(raw) % 8, np.uint8)]).view(np.uint64)


def build(m: np.ndarray) -> tuple[np.ndarray, int]:
    """slices[component, digit] of the rows' components above the smallest one, which is returned too."""
    low = int(m.min(initial=0))
    digits = max(1, int(m.max(initial=0) - low).bit_length())
    up = m - low
    return np.stack([np.stack([_pack((up[:, d] >> b) & 1) for b in range(digits)]) for d in range(m.shape[1])]), low


def scores(slices: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """sums[digit, query, word]: sum of |q| * component, components of negative factors complemented."""
    dims, digits, words = slices.shape
    size = np.abs(queries)
    wide = max(1, int(size.max(initial=0)).bit_length())
    total = digits + wide + max(1, dims).bit_length()
    sums = np.zeros((total, len(queries), words), np.uint64)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    for d in range(dims):
        flip = np.where(queries[:, d] < 0, ones, np.uint64(0))[:, None]
        own = slices[d][:, None, :] ^ flip[None]
        for k in range(wide):
            use = ((size[:, d] >> k) & 1).astype(bool)
            if not use.any():
                continue
            mask = np.where(use, ones, np.uint64(0))[:, None]
            carry = None
            for b in range(digits):
                x = own[b] & mask
                s = sums[k + b]
                half = s ^ x
                both = s & x
                if carry is None:
                    sums[k + b], carry = half, both
                else:
                    sums[k + b] = half ^ carry
                    carry = both | (half & carry)
            for b in range(k + digits, total):
                if not carry.any():
                    break
                s = sums[b].copy()
                sums[b] = s ^ carry
                carry = s & carry
    return sums


def select(sums: np.ndarray, alive: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sure, tied) bitmaps of one query: rows among the k best, and rows equal at the boundary."""
    sure, tied = np.zeros_like(alive), alive.copy()
    for s in sums[::-1]:
        first = tied & s
        have = int(np.bitwise_count(sure | first).sum())
        if have > k:
            tied = first
        else:
            sure |= first
            tied = tied & ~s
            if have == k:
                return sure, np.zeros_like(tied)
    return sure, tied


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def best_in_block(ids: np.ndarray, m: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row id, score) of each query's k best rows of a block, its own id left out; rows in order of id."""
    dims = max(m.shape[1], queries.shape[1])
    m = np.pad(m, ((0, 0), (0, dims - m.shape[1])))
    queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
    out_q, out_r, out_s = [], [], []
    if dims == 0:
        slices = np.zeros((0, 1, -(-len(ids) // 64)), np.uint64)
    else:
        slices, _ = build(m)
    there = _pack(np.ones(len(ids), bool))
    for a in range(0, len(queries), TOGETHER):
        some = queries[a : a + TOGETHER]
        sums = scores(slices, some)
        for q, (qid, vector) in enumerate(zip(query_ids[a : a + TOGETHER], some, strict=True)):
            alive = there & ~_pack(ids == qid)
            sure, tied = select(sums[:, q], alive, k)
            rows = _rows(sure)
            rows = np.concatenate([rows, _rows(tied)[: k - len(rows)]])
            out_q.append(np.full(len(rows), qid))
            out_r.append(ids[rows])
            out_s.append(m[rows] @ vector)
    if not out_q:
        return (np.empty(0, np.int64),) * 3
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_s)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of ``vectors`` with the largest integer inner product for each query.

    Ties go to the smaller vec_id; a query's own id is no candidate. Rows that repeat an id are separate
    candidates; an id that stands in several query rows is one query, the row with the smallest vector. Vectors
    that are null or hold null or non-finite components take no part on either side; a shorter vector counts as ending in
    zeros. Fewer than k candidates give fewer rows; empty tables give none. Columns other than the two named are not read.
    """
    spark = small_batches(vectors.sparkSession)
    rows = materialize(quantise(vectors, id_col, column), "vectors")
    asked = materialize(quantise(queries, id_col, column).groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n, nq = rows.count(), asked.count()
    blocks, chunks = -(-n // BLOCK) or 1, -(-nq // QUERIES) or 1
    spread = lambda many: F.expr(f"pmod(xxhash64(vec_id, 11L), {many}L)")
    # each index block meets each query block; a row is sent once for each query block, a query once for each index block
    left = rows.withColumn("block", spread(blocks)).withColumn("chunk", F.explode(F.expr(f"sequence(0L, {chunks - 1}L)")))
    right = asked.withColumn("chunk", spread(chunks)).withColumn("block", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))

    def meet(own: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(ask):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        own = own.sort_values("vec_id", kind="stable")
        q, r, s = best_in_block(own["vec_id"].to_numpy(), _matrix(own["v"]), ask["vec_id"].to_numpy(), _matrix(ask["v"]), k)
        return pd.DataFrame({"query_id": q, "vec_id": r, "score": s})

    part = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInPandas(meet, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(range(1, len(r.v) + 1), lambda i: r.v[i] * q.v[i]))::BIGINT AS score
  FROM rows q JOIN rows r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
