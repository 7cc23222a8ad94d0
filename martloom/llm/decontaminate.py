"""Benchmark decontamination by templates.

Numbers, names and units become typed placeholders, so a question with other numbers or names has the same template. Windows of
eight template tokens of the documents are hash-joined with those of the benchmark; windows of a document that stand
at one distance from an item's are one match. Windows whose placeholders hold the item's own values count as they are. Where
values were replaced, one value of the item must always have become the same new value, or only those windows count. An exact copy is the case where nothing changed. An item whose windows hold too
few words of their own gets wider ones, and if it has too few in all, one key over its whole template and one over its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bit_filter, lists, passes, pieces, small_batches
from martloom.llm.hashing import mix, segments, span_hashes
from martloom.session import materialize

WIDTH = 8  # tokens of a window
LITERAL = 5  # of them at least so many are no placeholders
TELLING = 3  # a whole template of at least so many literal tokens tells an item whose windows hold too few
SHORTEST = 4  # items of fewer tokens are too common to be told from chance and are not looked for
COVERED = 0.4  # share of an item's windows that makes a leak

NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "km m cm mm mi ft in yd kg g mg lb lbs oz l ml h hr hrs min s sec ms hz khz mhz ghz v w kw mw j kj cal kcal n pa kpa c f k "
    "kb mb gb tb usd eur gbp dollars euros pounds cents meters metres kilometers kilometres miles feet inches yards grams kilograms "
    "ounces liters litres seconds minutes hours days weeks months years percent degrees"
).split()
LITERAL_KIND, NUMBER, NAME, UNIT = range(4)
WINDOWS, WHOLE, VERBATIM = range(3)  # what a key stands for: a window, a whole template, a whole item word by word

_LETTER = np.zeros(256, bool)
_LETTER[np.r_[48:58, 65:91, 97:123, 128:256]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_BLANK = np.zeros(256, bool)
_BLANK[[9, 32]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 13, 33, 34, 46, 58, 63]] = True  # a word behind a line end or one of !".:? may be capitalised without being a name


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
    return np.sort(span_hashes(data, np.r_[0, ends[:-1] + 1], ends))


_NUMBER_HASHES, _UNIT_HASHES = _hashes(NUMBER_WORDS), _hashes(UNITS)
_HOLE = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


def template(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, kind) of each token: runs of letters and digits, a dot or comma between digits belonging to a number."""
    values, kinds = [], []
    for _, part in segments([raw], _SPACE):
        data = np.frombuffer(part, np.uint8)
        if not len(data):
            continue
        digit = _DIGIT[data]
        inside = np.zeros(len(data), bool)
        inside[1:-1] = digit[:-2] & digit[2:] & ((data[1:-1] == 46) | (data[1:-1] == 44))
        word = _LETTER[data] | inside
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(starts):
            continue
        value = span_hashes(np.frombuffer(part.lower(), np.uint8), starts, ends)
        numeric = np.concatenate([[0], np.cumsum(digit | inside)])
        number = (numeric[ends] - numeric[starts] == ends - starts) | _in(_NUMBER_HASHES, value)
        first, second = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
        title = (first >= 65) & (first <= 90) & (ends - starts > 1) & (((second >= 97) & (second <= 122)) | (second >= 128))
        last = np.maximum.accumulate(np.where(_BLANK[data], -1, np.arange(len(data))))  # nearest byte that is no blank
        before = np.where(starts > 0, last[starts - 1], -1)
        opening = (before < 0) | _STOP[data[before]]
        kind = np.where(number, NUMBER, np.where(title & ~opening, NAME, LITERAL_KIND))
        follows = np.concatenate([[False], number[:-1]])
        kind = np.where(follows & (kind == LITERAL_KIND) & _in(_UNIT_HASHES, value), UNIT, kind)
        values.append(value)
        kinds.append(kind)
    if not values:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(values), np.concatenate(kinds)


def windows(value: np.ndarray, kind: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the windows of ``width`` template tokens that hold enough literal ones."""
    n = len(value) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    shape = np.where(kind == LITERAL_KIND, value, _HOLE[kind])
    factor = mix(np.arange(1, width + 1, dtype=np.uint64) + np.uint64(777 * width)) | np.uint64(1)
    run = np.zeros(n, np.uint64)
    for k in range(width):
        run += shape[k : k + n] * factor[k]
    literal = np.concatenate([[0], np.cumsum(kind == LITERAL_KIND)])
    place = np.flatnonzero(literal[width:] - literal[:-width] >= min(LITERAL, width - 1))
    return mix(run[place]), place


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def whole(value: np.ndarray, kind: np.ndarray, width: int, mode: int) -> np.ndarray:
    """Hash of each run of ``width`` tokens, by template or by words. A name that begins a run counts as a word, as at the start of an item."""
    n = len(value) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    shape = value if mode == VERBATIM else np.where(kind == LITERAL_KIND, value, _HOLE[kind])
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(shape * _powers(_BASE, len(shape)), dtype=np.uint64)])
    run = (total[width:] - total[:-width]) * _powers(_BACK, n)
    first = np.where(kind[:n] == NAME, value[:n], shape[:n])
    return mix(run - shape[:n] + first + np.uint64(1_000_003 * width + mode))


def _slots(value: np.ndarray, kind: np.ndarray, at: int, width: int) -> np.ndarray:
    return value[at : at + width][kind[at : at + width] != LITERAL_KIND].view(np.int64)


def _filled(value: np.ndarray, kind: np.ndarray, at: int, width: int, mode: int) -> np.ndarray:
    if mode == VERBATIM:
        return np.empty(0, np.int64)
    if mode == WHOLE and kind[at] == NAME:  # counted as a word
        return _slots(value, kind, at + 1, width - 1)
    return _slots(value, kind, at, width)


def _width(kind: np.ndarray) -> int:
    """The least width from ``WIDTH`` on of which a window holds enough literal tokens; 0 if there is none."""
    literal = np.flatnonzero(kind == LITERAL_KIND)
    w = min(WIDTH, len(kind))
    need = min(LITERAL, w - 1)
    if len(literal) < need:
        return 0
    return max(w, int((literal[need - 1 :] - literal[: len(literal) - need + 1]).min()) + 1)


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in pieces(batch):
            ids, mode, width, count, key, place, slots = [], [], [], [], [], [], []
            for item, text in zip(part.column("item_id").to_pylist(), texts, strict=True):
                value, kind = template(text.encode("utf-8", "surrogatepass"))
                if len(value) < SHORTEST:
                    continue
                w = _width(kind)
                if w:
                    found, at = windows(value, kind, w)
                    keys = [(WINDOWS, found, at, [_slots(value, kind, a, w) for a in at])]
                else:
                    w, start = len(value), np.zeros(1, np.int64)
                    keys = [(VERBATIM, whole(value, kind, w, VERBATIM), start, [np.empty(0, np.int64)])]
                    if (kind == LITERAL_KIND).sum() >= TELLING:
                        keys.append((WHOLE, whole(value, kind, w, WHOLE), start, [_slots(value, kind, 0, w)]))
                for m, found, at, own in keys:
                    ids += [item] * len(at)
                    mode += [m] * len(at)
                    width += [w] * len(at)
                    count += [len(at)] * len(at)
                    key += found.view(np.int64).tolist()
                    place += at.tolist()
                    slots += own
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(mode, pa.int32()), pa.array(width, pa.int32()), pa.array(count, pa.int64()), pa.array(key, pa.int64()), pa.array(place, pa.int64()), lists(slots)],
                    names=["item_id", "mode", "width", "n_windows", "key", "place", "slots"],
                )


def _document_rows(wanted: np.ndarray, widths: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in pieces(batch):
                row, key, place, slots = [], [], [], []
                for k, text in enumerate(texts):
                    value, kind = template(text.encode("utf-8", "surrogatepass"))
                    for w, mode in widths:
                        if mode == WINDOWS:
                            found, at = windows(value, kind, w)
                        else:
                            found = whole(value, kind, w, mode)
                            at = np.arange(len(found))
                        hit = passes(wanted, found)
                        if hit.any():
                            some = at[hit]
                            row += [k] * len(some)
                            key += found[hit].view(np.int64).tolist()
                            place += some.tolist()
                            slots += [_filled(value, kind, a, w, mode) for a in some]
                if row:
                    pick = pa.array(row, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pick), part.column("h").take(pick), pa.array(key, pa.int64()), pa.array(place, pa.int64()), lists(slots)],
                        names=["doc_id", "h", "key", "at", "found"],
                    )

    return run


def text_hash():
    return F.xxhash64(F.col("text"))


def leaks(docs: DataFrame, benchmark: DataFrame, covered: float = COVERED) -> DataFrame:
    """doc_id, h (hash of the text), item_id, matched, n_windows, coverage, changed for each document that holds a benchmark item.

    ``changed`` counts the item's placeholder values that the document replaced by others, somewhere or everywhere. Null and empty texts match
    nothing; null and repeated ids are told apart by ``h``; rows that repeat a document give one row together. Items
    without an id or with fewer than four tokens are not looked for. Only doc_id and text, item_id and text are read.
    """
    spark = small_batches(docs.sparkSession)
    items = materialize(
        benchmark.where("item_id is not null")
        .select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_item_rows, "item_id long, mode int, width int, n_windows long, key long, place long, slots array<long>"),
        "items",
    )
    widths = sorted((r.width, r.mode) for r in items.select("width", "mode").distinct().collect())
    wanted = bit_filter(items, "key", items.count(), each=1024, least=1 << 22)
    shared = spark.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _document_rows(shared.value, widths)(batches)

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("h", text_hash())
        .mapInArrow(run, "doc_id long, h long, key long, at long, found array<long>")
    )
    replaced = F.filter(F.array_distinct(F.flatten("filled")), lambda s: s["slots"] != s["found"])
    consistent = F.expr("size(array_distinct(p.slots)) = size(p)")
    matches = (
        rows.join(items.select("item_id", "n_windows", "key", "place", "slots"), "key")
        .groupBy("doc_id", "h", "item_id", "n_windows", F.expr("at - place").alias("shift"))
        .agg(
            F.size(F.collect_set("place")).alias("all"),
            F.size(F.collect_set(F.expr("if(slots = found, place, null)"))).alias("same"),
            F.collect_set(F.arrays_zip("slots", "found")).alias("filled"),
        )
        .withColumn("p", replaced)
        .withColumn("matched", F.when(consistent, F.col("all")).otherwise(F.col("same")))
        .withColumn("coverage", F.col("matched") / F.col("n_windows"))
        .where(F.col("coverage") >= covered)
        .withColumn("changed", F.size(F.expr("array_distinct(p.slots)")))
    )
    best = F.max(F.struct("coverage", F.expr("-changed").alias("same"), "matched", "n_windows")).alias("b")
    return (
        matches.groupBy("doc_id", "h", "item_id")
        .agg(best)
        .select("doc_id", "h", "item_id", "b.matched", "b.n_windows", "b.coverage", F.expr("cast(-b.same as int)").alias("changed"))
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, columns as they were."""
    found = materialize(leaks(docs, benchmark).select(F.col("doc_id").alias("_id"), F.col("h").alias("_h")).distinct(), "leaks")
    same = docs["doc_id"].cast("long").eqNullSafe(found["_id"]) & (F.xxhash64(docs["text"].cast("string")) == found["_h"])
    return docs.join(found, same, "left_anti").select(*docs.columns)
