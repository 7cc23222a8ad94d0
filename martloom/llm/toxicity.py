"""Toxicity: a subsequence string kernel over words, a support vector machine on Nyström landmarks.

The kernel counts common subsequences of three characters, each weighted down by the length it spans, so an
insult still resembles itself with characters put in or left out. A text is read word by word; runs of single
characters are read as one word too ("i d i o t"). Landmarks are words of the labelled sample; the machine is
trained in the space they span. As the kernel is a product of sparse vectors, the trained machine folds into
one table of weights, one for each subsequence, and scoring a word is a sum over its subsequences. A document's score
comes from its two worst words, so an insult counts the same in a short and a long text.

Training reads a bounded sample of labelled documents (``sample`` of each label, by hash of the id); everything else,
scoring first of all, reads whole texts of all rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import crc_of_id, pieces, small_batches
from martloom.session import materialize

DECAY, SPAN = 0.6, 7  # weight of each further character, most characters a subsequence spans
LETTERS = 64  # symbols: letters as they are, everything else by hash
LONGEST, STEP = 16, 8  # longer words are read in overlapping parts
COST = 2000.0  # weight of all errors against the size of the weights
CACHE = 300_000  # words a worker remembers
FAR = -9.0  # margin of a document without words

_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_ACCENTED = "àáâãäåæçèéêëìíîïñòóôõöøùúûüýßœ"
_SYMBOL = {c: k + 1 for k, c in enumerate("abcdefghijklmnopqrstuvwxyz" + _ACCENTED)}


_SYMBOL |= {"^": 62, "$": 63}  # where a word begins and ends


def _symbol(c: str) -> int:
    return _SYMBOL.get(c) or 57 + ord(c) % 5


def units(text: str) -> set[str]:
    """Lower-cased words without signs at their ends, the letters alone of words with other signs in them, and runs of
    three or more single characters joined."""
    raw = text.lower().split()
    found = set(raw)
    if len(raw) > 2:
        single = [len(w) == 1 for w in raw]
        if any(single):
            k = 0
            while k < len(raw):
                if single[k]:
                    end = k
                    while end < len(raw) and single[end]:
                        end += 1
                    if end - k > 2:
                        found.add("".join(raw[k:end]))
                    k = end
                k += 1
    mixed = [_EDGE.sub("", w) for w in found if not w.isalpha()]
    plain = {w for w in found if w.isalpha()}
    return plain.union(mixed, ("".join(filter(str.isalpha, w)) for w in mixed if not w.isalpha())) - {""}


def _parts(word: str) -> list[str]:
    word = f"^{word}$"
    if len(word) <= LONGEST:
        return [word]
    return [word[k : k + LONGEST] for k in range(0, len(word) - STEP, STEP)]


_triples: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _positions(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _triples:
        at = [(i, j, k) for i, j, k in combinations(range(n), 3) if k - i < SPAN]
        _triples[n] = np.array(at, np.int64).reshape(-1, 3), np.array([DECAY ** (k - i + 1) for i, _, k in at], np.float32)
    return _triples[n]


def features(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, codes, weights) of words of equal length: normed weights of their subsequences."""
    by_length: dict[int, list[int]] = {}
    for row, word in enumerate(words):
        by_length.setdefault(max(3, len(word)), []).append(row)
    for n, rows in by_length.items():
        at, weight = _positions(n)
        for a in range(0, len(rows), 4096):
            some = rows[a : a + 4096]
            chars = np.zeros((len(some), n), np.int32)
            for k, row in enumerate(some):
                word = words[row]
                chars[k, : len(word)] = [_symbol(c) for c in word]
            codes = (chars[:, at[:, 0]] * LETTERS + chars[:, at[:, 1]]) * LETTERS + chars[:, at[:, 2]]
            order = np.argsort(codes, axis=1, kind="stable")
            codes = np.take_along_axis(codes, order, 1)
            w = weight[order]
            new = np.ones(codes.shape, bool)
            new[:, 1:] = codes[:, 1:] != codes[:, :-1]
            first = np.flatnonzero(new.ravel())
            value = np.add.reduceat(w.ravel(), first)  # equal subsequences of a word add up
            row_of = first // codes.shape[1]
            norm = np.sqrt(np.bincount(row_of, value * value, len(some)))
            yield np.array(some)[row_of], codes.ravel()[first], (value / norm[row_of]).astype(np.float32)


def margins(words: list[str], table: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin of each word; of a long word, its worst part's."""
    flat, owner = [], []
    for k, word in enumerate(words):
        for part in _parts(word):
            flat.append(part)
            owner.append(k)
    value = np.zeros(len(flat))
    for rows, codes, weights in features(flat):
        value += np.bincount(rows, table[codes] * weights, len(flat))
    out = np.full(len(words), FAR)
    np.maximum.at(out, np.array(owner, np.int64), value + bias)
    return out


def _vectors(words: list[str], codes_of: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Kernel of each word with the landmarks: ``marks`` holds their weights, a row for each of ``codes_of``."""
    out = np.zeros((len(words), marks.shape[1]), np.float32)
    for rows, codes, weights in features(words):
        at = np.minimum(np.searchsorted(codes_of, codes), len(codes_of) - 1)
        hit = codes_of[at] == codes
        rows, at, weights = rows[hit], at[hit], weights[hit]
        for k in range(0, len(rows), 20_000):
            np.add.at(out, rows[k : k + 20_000], marks[at[k : k + 20_000]] * weights[k : k + 20_000, None])
    return out


def train_machine(good: list[str], bad: dict[str, float], landmarks: int) -> tuple[np.ndarray, float]:
    """Weights by subsequence and bias of a squared-hinge machine; ``bad`` words weigh as given, both sides weigh the same.

    A long word is learnt whole, by its overlapping parts, which share its weight.
    """
    parts = [_parts(w) for w in [*bad, *good]]
    words = [p for some in parts for p in some]
    lengths = np.array([len(some) for some in parts])
    sign = np.repeat(np.r_[np.ones(len(bad)), -np.ones(len(good))], lengths)
    share = np.r_[np.array(list(bad.values())) / sum(bad.values()), np.full(len(good), 1 / max(1, len(good)))]
    share = np.repeat(share / lengths, lengths)
    n_bad = int(lengths[: len(bad)].sum())
    pick = words[: min(n_bad, landmarks // 2)]
    pick = list(dict.fromkeys(pick + words[n_bad : n_bad + landmarks - len(pick)]))
    found = list(features(pick))
    codes_of = np.unique(np.concatenate([codes for _, codes, _ in found]))
    marks = np.zeros((len(codes_of), len(pick)), np.float32)
    for rows, codes, weights in found:
        marks[np.searchsorted(codes_of, codes), rows] = weights
    value, vector = np.linalg.eigh((marks.T @ marks).astype(np.float64))
    keep = value > 1e-4
    root = vector[:, keep] / np.sqrt(value[keep])  # Nystroem: the landmarks' space, made orthonormal
    x = np.c_[_vectors(words, codes_of, marks) @ root, np.ones(len(words))]
    cost = share * COST
    w = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-3
    for _ in range(25):  # Newton steps on the active rows
        gap = 1 - sign * (x @ w)
        on = gap > 0
        xa = x[on] * cost[on, None]
        step = np.linalg.solve(ridge + xa.T @ x[on], ridge @ w - xa.T @ (sign[on] * gap[on]))
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    table = np.zeros(LETTERS**3, np.float32)
    table[codes_of] = marks @ (root @ w[:-1])
    return table, float(w[-1])


@dataclass
class Model:
    """``table`` and ``bias`` give a word's margin; ``link`` turns the two largest into a probability."""

    table: np.ndarray
    bias: float
    link: np.ndarray

    def worst(self, texts: list[str], known: dict[str, float]) -> np.ndarray:
        """The two largest margins of each text and which word has the largest."""
        found = [units(t) for t in texts]
        new = list(set().union(*found) - known.keys())
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(set().union(*found))
        known.update(zip(new, margins(new, self.table, self.bias).tolist(), strict=True))
        out = np.full((len(texts), 2), FAR)
        for k, words in enumerate(found):
            if words:
                some = sorted(map(known.__getitem__, words))[-2:]
                out[k, 2 - len(some) :] = some
        return out[:, ::-1]

    def score(self, worst: np.ndarray) -> np.ndarray:
        x = np.clip(worst, -3, 3)
        return 1 / (1 + np.exp(-np.clip(np.c_[x, np.ones(len(x))] @ self.link, -30, 30)))


def _calibrate(worst: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Logistic weights of the two margins by Newton steps; the rarer label weighs up to twice as much."""
    x = np.c_[np.clip(worst, -3, 3), np.ones(len(worst))]
    w = np.zeros(3)
    share = max(label.mean(), 1e-6)
    each = np.where(label > 0, min(2.0, max(1.0, 0.5 / share)), 1.0)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (each * p * (1 - p))[:, None]).T @ x + np.eye(3) * 0.1
        w = w - np.linalg.solve(h, x.T @ (each * (p - label)) + 0.1 * w)
    return w


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each word of a text once, with the words on either side of its first place."""
    for batch in batches:
        for part, texts in pieces(batch):
            words, left, right, label = [], [], [], []
            for text, y in zip(texts, part.column("label").to_pylist(), strict=True):
                raw = ["", *text.lower().split(), ""]
                first = {w: k for k, w in reversed(list(enumerate(raw)))}
                for w in sorted(first):
                    unit = w if w.isalpha() else _EDGE.sub("", w)
                    if unit:
                        words.append(unit)
                        left.append(raw[first[w] - 1])
                        right.append(raw[first[w] + 1])
                        label.append(y)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(label, pa.int32())],
                names=["unit", "left", "right", "label"],
            )


SURE, FOUND, DOUBTED = 1500, 1500, 20_000  # words of toxic documents a machine is trained on, found by a round, looked through
USUAL, OTHERS = 1000, 6000  # words of clean documents, the most frequent and by hash


def _worst_rows(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in batches:
            for part, texts in pieces(batch):
                worst = model.worst(texts, known)
                unit = [max(sorted(units(t)), key=known.get, default="") for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(unit), pa.array(worst[:, 0].copy()), pa.array(worst[:, 1].copy())], names=["label", "unit", "m1", "m2"]
                )

    return run


def train(docs: DataFrame, labels: DataFrame, sample: int = 2000, landmarks: int = 192) -> Model | None:
    """Learn from ``labels`` (doc_id, toxic); null labels and ids are passed over.

    A word counts once for each different word beside it, so copies of one text don't add up. Sure insults stand in more places
    of toxic documents than chance allows and in no clean document; then words of toxic documents that the machine finds alike, and the
    worst words of clean documents, join in two further rounds. None if a label has no document.

    What the machine learns from is bounded: ``sample`` documents of each label, of their words at most SURE and FOUND
    insults, DOUBTED words looked through for those, USUAL frequent and OTHERS further words of clean documents.
    """
    small_batches(docs.sparkSession)
    marked = labels.where("doc_id is not null and toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("label")).distinct()
    order = F.xxhash64("doc_id", F.lit(7))
    picked = marked.where("label = 1").orderBy(order, "doc_id").limit(sample).union(marked.where("label = 0").orderBy(order, "doc_id").limit(sample))
    own = materialize(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "label"), "sample")
    n_bad, n_all = (int(x or 0) for x in own.agg(F.sum("label"), F.count("*")).first())
    if not 0 < n_bad < n_all:
        return None
    seen_by = lambda side: F.count_distinct(F.when(F.col("label") == 1, F.col(side)))
    counts = materialize(
        own.mapInArrow(_unit_rows, "unit string, left string, right string, label int")
        .groupBy("unit")
        .agg(F.least(seen_by("left"), seen_by("right")).alias("bad"), F.sum(F.expr("1 - label")).alias("good")),
        "units",
    )
    words = counts.count()
    base = n_bad / n_all
    chance = max(3, int(np.ceil(np.log(words * 20) / -np.log(base))) if base < 1 else 3)  # expected by chance in a twentieth of a word
    hashed = F.xxhash64("unit")
    only = counts.where("good = 0")
    sure = only.where(F.col("bad") >= chance).orderBy(F.desc("bad"), "unit").limit(SURE).toPandas()
    if not len(sure):
        sure = only.orderBy(F.desc("bad"), "unit").limit(20).toPandas()
    bad = dict(zip(sure["unit"], np.sqrt(sure["bad"].astype(float)), strict=True))
    doubt = only.where(F.col("bad").between(2, chance - 1)).orderBy(F.desc("bad"), "unit").limit(DOUBTED).toPandas()["unit"].tolist()
    usual = counts.where("good > 0").orderBy(F.desc("good"), "unit").limit(USUAL).toPandas()["unit"].tolist()
    others = counts.where("good > 0").orderBy(hashed, "unit").limit(OTHERS).toPandas()["unit"].tolist()
    good = list(dict.fromkeys(others[:landmarks] + usual + others))
    for turn in range(3):
        table, bias = train_machine(good, bad, landmarks)
        model = Model(table, bias, np.zeros(3))
        seen = own.coalesce(8).mapInArrow(_worst_rows(model), "label int, unit string, m1 double, m2 double").toPandas()
        if turn < 2:
            clean = sorted(set(seen.loc[(seen["label"] == 0) & (seen["m1"] > -0.8), "unit"]))
            found = margins(doubt, table, bias) if doubt else np.empty(0)
            near = [w for w, m in zip(doubt, found, strict=True) if m > 0.5][:FOUND]
            bad |= {w: 1.0 for w in near if w not in bad}
            good = list(dict.fromkeys(clean[: landmarks // 2] + [w for w in good if w not in bad] + clean))
    model.link = _calibrate(seen[["m1", "m2"]].to_numpy(), seen["label"].to_numpy(float))
    return model


def toxic_score(model: Model | None) -> Callable[[Column], Column]:
    """A column function text -> score. Null and empty texts get the score of a text without words.

    Without a model (no usable labels) every score is 0.
    """
    if model is None:
        return lambda text: F.lit(0.0)

    @F.pandas_udf("double")
    def margin(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known: dict[str, float] = {}
        for texts in parts:
            some = [t or "" for t in texts]
            out, start, held = [], 0, 0
            for k, text in enumerate(some):
                held += len(text)
                if held > 4 << 20 or k == len(some) - 1:
                    out.append(model.score(model.worst(some[start : k + 1], known)))
                    start, held = k + 1, 0
            yield pd.Series(np.concatenate(out) if out else np.empty(0))

    return margin


def held_out() -> Column:
    return F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(5)) == 0, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learnt from the labels of rows that are not held out.

    Rows keep their number, repeated ones and those with null ids too; other columns of ``docs`` are not read.
    """
    score = toxic_score(train(docs, labels.where(~held_out())))
    return docs.select("doc_id", held_out().alias("held_out"), score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model learnt from ``labels`` does not call toxic, columns as they were."""
    score = toxic_score(train(docs, labels.where(~held_out())))
    return docs.where(score(F.col("text")) < 0.5)
