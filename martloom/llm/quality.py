"""Quality classifier: a convolutional network over bytes, in numpy.

Bytes become small learned vectors; learned filters run over them; each filter's largest answer is taken over
chunks of 512 bytes that overlap by half and cover the whole text. A text's largest, smallest and mean
chunk answers go through one hidden layer into one probability. The smallest tells texts that repeat themselves:
where few patterns stand, few filters answer.

Training reads a bounded sample of labelled rows: up to ``sample`` of each label by hash of the id, and of these up to
``sample_bytes`` in all. Scoring reads whole texts of all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import crc_of_id, small_batches

VECTOR, WIDTH, FILTERS, HIDDEN = 4, 8, 24, 16
BLOCK, BLOCKS, STRIDE = 64, 8, 4  # a chunk is 8 blocks, a new one begins every 4
SLICE = 1 << 18  # bytes worked on at a time


def _layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each filled up to whole blocks, and the blocks of each.

    A block of zeros, in no chunk, stands behind each text, so that no window reaches into the next one.
    """
    blocks = np.array([len(t) // BLOCK + 1 for t in texts])
    data = np.zeros(int((blocks + 1).sum()) * BLOCK + WIDTH, np.uint8)
    at = 0
    for text, n in zip(texts, blocks, strict=True):
        data[at : at + len(text)] = np.frombuffer(text, np.uint8)
        at += (int(n) + 1) * BLOCK
    return data, blocks


def _chunks(blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each chunk, all texts in a row, and chunks of each text."""
    first, size, count = [], [], []
    base = 0
    for n in blocks.tolist():
        starts = range(0, max(1, n - BLOCKS + STRIDE), STRIDE)
        first += [base + s for s in starts]
        size += [min(BLOCKS, n - s) for s in starts]
        count.append(len(starts))
        base += n + 1
    return np.array([first, size]), np.array(count)


class Network:
    """Weights by name; ``forward`` keeps what ``step`` needs to learn."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.w = {
            "embed": rng.normal(0, 0.5, (256, VECTOR)),
            "filter": rng.normal(0, 1 / np.sqrt(VECTOR * WIDTH), (WIDTH * VECTOR, FILTERS)),
            "bias": np.zeros(FILTERS),
            "hidden": rng.normal(0, 1 / np.sqrt(3 * FILTERS), (3 * FILTERS, HIDDEN)),
            "hidden_bias": np.zeros(HIDDEN),
            "out": rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            "out_bias": np.zeros(1),
        }
        self.w = {k: v.astype(np.float32) for k, v in self.w.items()}
        self.moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.w.items()}
        self.turn = 0

    def _answers(self, data: np.ndarray) -> np.ndarray:
        x = self.w["embed"][data]
        n = len(data) - WIDTH
        view = np.lib.stride_tricks.as_strided(x, (n, WIDTH * VECTOR), (x.strides[0], x.strides[1]))
        return view @ self.w["filter"]

    def _block_maxima(self, data: np.ndarray, where: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Largest answer of each filter in each block, and its byte if ``where``."""
        total = (len(data) - WIDTH) // BLOCK
        top = np.empty((total, FILTERS), np.float32)
        at = np.empty((total, FILTERS), np.int64) if where else None
        step = SLICE // BLOCK
        for a in range(0, total, step):
            b = min(total, a + step)
            answers = self._answers(data[a * BLOCK : b * BLOCK + WIDTH]).reshape(b - a, BLOCK, FILTERS)
            top[a:b] = answers.max(1)
            if where:
                at[a:b] = answers.argmax(1) + (np.arange(a, b) * BLOCK)[:, None]
        return top, at

    def forward(self, texts: list[bytes], learn: bool = False) -> dict:
        data, blocks = _layout(texts)
        top, at = self._block_maxima(data, learn)
        (first, size), count = _chunks(blocks)
        pick = first[:, None] + np.minimum(np.arange(BLOCKS), size[:, None] - 1)
        best = np.full((len(first), FILTERS), -np.inf, np.float32)
        which = np.zeros((len(first), FILTERS), np.int64)
        for k in range(BLOCKS):
            now = top[pick[:, k]]
            if learn:
                which = np.where(now > best, pick[:, k][:, None], which)
            best = np.maximum(best, now)
        chunk = np.maximum(best + self.w["bias"], 0)
        starts = np.concatenate([[0], np.cumsum(count)[:-1]])
        largest, smallest = np.maximum.reduceat(chunk, starts), np.minimum.reduceat(chunk, starts)
        mean = np.add.reduceat(chunk, starts) / count[:, None]
        x = np.concatenate([largest, smallest, mean], 1)
        h = np.maximum(x @ self.w["hidden"] + self.w["hidden_bias"], 0)
        z = h @ self.w["out"] + self.w["out_bias"][0]
        return {
            "p": 1 / (1 + np.exp(-np.clip(z, -30, 30))), "x": x, "h": h, "chunk": chunk, "count": count, "starts": starts, "which": which, "at": at, "data": data,
        }

    def step(self, texts: list[bytes], label: np.ndarray, weight: np.ndarray, rate: float) -> float:
        """One step of Adam down the weighted log loss; answers the loss."""
        f = self.forward(texts, True)
        p = f["p"]
        dz = ((p - label) * weight / len(texts)).astype(np.float32)
        g = {"out": f["h"].T @ dz, "out_bias": dz.sum(keepdims=True)}
        dh = dz[:, None] * self.w["out"] * (f["h"] > 0)
        g["hidden"], g["hidden_bias"] = f["x"].T @ dh, dh.sum(0)
        dx = dh @ self.w["hidden"].T
        owner = np.repeat(np.arange(len(texts)), f["count"])
        n = len(f["chunk"])
        dchunk = dx[owner, 2 * FILTERS :] / f["count"][owner][:, None]
        for part, pick in ((0, np.maximum), (1, np.minimum)):
            edge = pick.reduceat(f["chunk"], f["starts"])
            tie = (f["chunk"] == edge[owner]).astype(np.float32)
            tie /= np.add.reduceat(tie, f["starts"])[owner]
            dchunk = dchunk + dx[owner, part * FILTERS : (part + 1) * FILTERS] * tie
        dchunk = (dchunk * (f["chunk"] > 0)).astype(np.float32)
        g["bias"] = dchunk.sum(0)
        byte = np.take_along_axis(f["at"], f["which"], 0)  # the byte where each chunk's largest answer begins
        windows = f["data"][byte[:, :, None] + np.arange(WIDTH)]  # chunk, filter, place
        vectors = self.w["embed"][windows].reshape(n, FILTERS, WIDTH * VECTOR)
        g["filter"] = np.einsum("nf,nfd->df", dchunk, vectors)
        back = dchunk[:, :, None] * self.w["filter"].T[None]
        codes = windows.reshape(-1)
        back = back.reshape(-1, VECTOR)
        g["embed"] = np.stack([np.bincount(codes, back[:, k], 256) for k in range(VECTOR)], 1)
        self.turn += 1
        for k, v in g.items():
            m, s = self.moment[k]
            m += 0.1 * (v - m)
            s += 0.01 * (v * v - s)
            self.w[k] -= (rate * (m / (1 - 0.9**self.turn)) / (np.sqrt(s / (1 - 0.99**self.turn)) + 1e-8)).astype(np.float32)
        eps = 1e-7
        return float(-(weight * (label * np.log(p + eps) + (1 - label) * np.log(1 - p + eps))).mean())


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 10, batch: int = 32) -> Network:
    """Train on whole texts, both labels weighing the same."""
    net = Network()
    rng = np.random.default_rng(2)
    share = max(1e-6, labels.mean())
    weight = np.where(labels > 0, 0.5 / share, 0.5 / max(1e-6, 1 - share))
    steps = epochs * (len(texts) // batch + 1)
    done = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for a in range(0, len(order), batch):
            some = order[a : a + batch]
            net.step([texts[k] for k in some], labels[some], weight[some], 0.01 * (1 - 0.9 * done / steps))
            done += 1
    net.moment = {}
    return net


def train(docs: DataFrame, labels: DataFrame, sample: int = 1000, sample_bytes: int = 8 << 20) -> Network | None:
    """Learn from ``labels`` (doc_id, quality); null labels and ids are passed over. None if a label has no document.

    Documents are taken label by label in order of a hash of their id until ``sample`` rows or ``sample_bytes`` / 2 bytes
    of text are reached; each is used whole. Those of over ``sample_bytes`` / 32 bytes come behind all others, the shortest
    first, and fill what is left. A label all of whose documents are over ``sample_bytes`` / 2 bytes has none.
    """
    rows = training_rows(docs, labels, sample, sample_bytes).toPandas()
    y = rows["label"].to_numpy(np.float32)
    if not len(y) or y.min() == y.max():
        return None
    return fit([bytes(t) for t in rows["text"]], y)


def training_rows(docs: DataFrame, labels: DataFrame, sample: int, sample_bytes: int) -> DataFrame:
    """text, label of the documents ``train`` learns from."""
    marked = labels.where("doc_id is not null and quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("label")).distinct()
    order = F.xxhash64("doc_id", F.lit(8))
    parts = [marked.where(f"label = {y}").orderBy(order, "doc_id").limit(sample) for y in (0, 1)]
    text = F.coalesce("text", F.lit("")).cast("binary")
    own = docs.select("doc_id", text.alias("text")).join(F.broadcast(parts[0].union(parts[1])), "doc_id")
    # rows that still fit the byte bound, long ones last, by the order of the hash: a window over at most 2 * sample rows
    size = F.octet_length("text")
    sized = own.withColumn("long", F.when(size > sample_bytes // 32, size).otherwise(0))
    fits = sized.withColumn("size", F.sum(size.cast("long")).over(_by_label())).where(F.col("size") <= sample_bytes // 2)
    return fits.orderBy(order, "doc_id", "label").select("text", "label")


def _by_label():
    from pyspark.sql import Window

    return Window.partitionBy("label").orderBy("long", F.xxhash64("doc_id", F.lit(8)), "doc_id").rowsBetween(Window.unboundedPreceding, 0)


def quality_score(net: Network | None) -> Callable[[Column], Column]:
    """A column function text -> probability of good quality; null reads as an empty text. Without a model 0.5."""
    if net is None:
        return lambda text: F.lit(0.5)

    @F.pandas_udf("double")
    def probability(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            some = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            out, start, held = [], 0, 0
            for k, text in enumerate(some):
                held += len(text)
                if held > 2 << 20 or k == len(some) - 1:
                    out.append(net.forward(some[start : k + 1])["p"])
                    start, held = k + 1, 0
            yield pd.Series(np.concatenate(out).astype(float) if out else np.empty(0))

    return probability


def held_out() -> Column:
    return F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(3)) == 1, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, learnt from the labels of rows that are not held out.

    Rows keep their number, repeated ones and those with null ids too; other columns of ``docs`` are not read. A score is
    that of the whole text alone, whatever else is scored with it. An empty table gives no rows; where a label has no row to
    learn from, every score is 0.5.
    """
    small_batches(docs.sparkSession)
    score = quality_score(train(docs, labels.where(~held_out())))
    return docs.select("doc_id", held_out().alias("held_out"), score(F.col("text")).alias("score")).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
