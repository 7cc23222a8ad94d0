"""Token counts by a two-tier lookup of pre-token lengths.

A text is cut into pre-tokens by the tokenizer's pattern; its token count is the sum of their token counts. The frequent ones come
from a compact table that every worker holds; the others are encoded by the tokenizer library, a batch at a time, and
remembered by the worker. No pre-token is ever shuffled. The table is a cache: what it holds changes the time, never a count.
"""

from __future__ import annotations

import json
import os
import sys
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.common import small_batches

FREQUENT = 1 << 16  # entries of the frequent table
REMEMBERED = 16 << 20  # characters of pre-tokens in a worker's own cache
ENCODED = 1000  # pre-tokens handed to the library at a time: its results are large
LIMIT = 1024


class Encoder:
    """Pre-token splitting and lengths of one byte-level tokenizer file, read when first needed on a worker."""

    def __init__(self, content: str, pattern: str):
        self.content, self.pattern = content, pattern
        self._ready = None

    def __getstate__(self):
        return {"content": self.content, "pattern": self.pattern, "_ready": None}

    def _tools(self):
        if self._ready is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
            from tokenizers import Tokenizer

            library = Tokenizer.from_str(self.content)
            library.no_truncation()
            library.no_padding()
            special = sorted((t["content"] for t in json.loads(self.content).get("added_tokens", [])), key=len, reverse=True)
            cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
            self._ready = library, regex.compile(self.pattern).findall, cut, {s for s in special}
        return self._ready

    def split(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of the text around special strings, and how many special strings it holds."""
        _, find, cut, special = self._tools()
        if cut is None or not cut.search(text):
            return find(text), 0
        found, count = [], 0
        for part in cut.split(text):
            if part in special:
                count += 1
            elif part:
                found += find(part)
        return found, count

    def lengths(self, pretokens: list[str]) -> list[int]:
        encode = self._tools()[0].encode_batch
        slices = (pretokens[a : a + ENCODED] for a in range(0, len(pretokens), ENCODED))
        return [len(e.ids) for some in slices for e in encode(some, add_special_tokens=False)]


class Worker:
    """Encoder, lengths and their bound, kept by a worker process for all its tasks."""

    def __init__(self, encoder: Encoder, known: dict[str, int]):
        self.encoder, self.known = encoder, known
        self.lengths, self.size = dict(known), 0

    @staticmethod
    def of_process(key: str, encoder: Encoder, known: Callable[[], dict[str, int]]) -> Worker:
        # this module travels with each task, so what outlives a task hangs on a module of the interpreter
        held = sys.__dict__.setdefault("_token_workers", {})
        if key not in held:
            held.clear()  # tables of earlier jobs
            held[key] = Worker(encoder, known())
        return held[key]

    def tally(self, found: list[tuple[list[str], int]]) -> list[int]:
        """Tokens of each text, given as pre-tokens and the number of its special strings."""
        if self.size > REMEMBERED:
            self.lengths, self.size = dict(self.known), 0
        out = []
        for pretokens, special in found:
            new = [t for t in set(pretokens) if t not in self.lengths]
            self.lengths.update(zip(new, self.encoder.lengths(new), strict=True))
            self.size += sum(map(len, new)) + 60 * len(new)
            out.append(sum(map(self.lengths.__getitem__, pretokens)) + special)
        return out


def frequent_table(docs: DataFrame, encoder: Encoder, sample: int = 2000) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of a bounded sample, ``sample`` documents by hash of id and text.

    A worker counts whole texts and returns ``FREQUENT`` entries at most.
    """

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for part in parts:
            for text in part["text"]:
                seen.update(encoder.split(text or "")[0])
                if len(seen) > 8 * FREQUENT:
                    seen = Counter(dict(seen.most_common(2 * FREQUENT)))
        top = [(t, n) for t, n in seen.most_common(FREQUENT) if n > 1 and len(t) < 64]
        yield pd.DataFrame(top, columns=["pretoken", "n"])

    ids = docs.select(F.col("doc_id"), F.xxhash64("doc_id", F.lit(6)).alias("h")).where("doc_id is not null").orderBy("h", "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id").distinct()), "doc_id").select("text")
    # the sampled texts move to few tasks, their counts to the driver: eight lists of FREQUENT entries at most
    total: Counter[str] = Counter()
    for r in rows.repartition(8).mapInPandas(count, "pretoken string, n long").collect():
        total[r.pretoken] += r.n
    words = [t for t, _ in sorted(total.items(), key=lambda e: (-e[1], e[0]))[:FREQUENT]]
    return dict(zip(words, encoder.lengths(words), strict=True)) if words else {}


def token_count(spark: SparkSession, encoder: Encoder, known: dict[str, int]) -> Callable[[Column], Column]:
    """A column function text -> number of tokens; null reads as an empty text."""
    small_batches(spark)
    shared = spark.sparkContext.broadcast(known)
    key = uuid.uuid4().hex

    @F.pandas_udf("long")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker = Worker.of_process(key, encoder, lambda: shared.value)
        for texts in parts:
            yield pd.Series(np.array([worker.tally([worker.encoder.split(t or "")])[0] for t in texts], np.int64))

    return count


def count_documents(docs: DataFrame, encoder: Encoder) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for every row; a null text counts as empty, ids may be null or repeat.

    Other columns are not read; a very long text is cut and counted whole, by itself; an empty table gives no rows. Special strings inside a text count as their one token, as the library reads them.
    """
    count = token_count(docs.sparkSession, encoder, frequent_table(docs, encoder))
    return docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), count(F.col("text")).alias("n_tokens")
    ).withColumn("over_limit", F.col("n_tokens") > LIMIT)
