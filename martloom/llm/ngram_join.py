"""N-gram Jaccard join: documents whose sets of 5-word shingles are alike, by token-combination prefixes.

A document's tokens are put into one order for all documents: rare tokens first, then frequent ones. If two sets
overlap enough, they share some of the first tokens: at a similarity of 0.8 a set of n tokens misses n // 5 of its own at most, so of
its first n // 5 + k any partner has k. k is a twentieth of n: a passage in common doesn't make a candidate, as one
shared token would. A frequent token alone would join too many documents, so frequent tokens are indexed as
combinations of two neighbours in that order, and the prefix is made longer for it: each missing token breaks up to two
combinations and each foreign one breaks one, at most 2n / 5 together, so 2n / 5 + k keys keep k whole.
Candidates found so are ordered once more by exact frequency, filtered by length and position, and verified on whole sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import bit_filter, lists, passes, pieces, small_batches, stored
from martloom.llm.components import components
from martloom.llm.hashing import mix, shingles, word_hashes

OFTEN = 4  # a token in so many documents of a chunk may be frequent
FREQUENT = 1 << 20  # most tokens that can be frequent: 8 MB in every worker
CHUNK = 1 << 21  # tokens counted at a time while looking for frequent ones

_PROFILE = "doc_id long, n long, digest binary, token long, seen long"


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, and rows of tokens seen in many of a chunk's documents."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("token", pa.int64()), ("seen", pa.int64())])
    held: list[np.ndarray] = []
    size = 0

    def common() -> pa.RecordBatch:
        token, seen = np.unique(np.concatenate(held), return_counts=True)
        many = seen >= OFTEN
        none = pa.nulls(int(many.sum()), pa.int64())
        return pa.RecordBatch.from_arrays(
            [none, none, pa.nulls(int(many.sum()), pa.binary()), pa.array(token[many].view(np.int64)), pa.array(seen[many])], schema=schema
        )

    for batch in batches:
        for part, texts in pieces(batch):
            sets = [shingles(w) for w in word_hashes(texts)]
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                    none,
                    none,
                ],
                schema=schema,
            )
            held += [s for s in sets if len(s)]
            size += sum(map(len, sets))
            if size > CHUNK:
                yield common()
                held, size = [], 0
    if held:
        yield common()


def needed(n: int) -> int:
    """Keys that a set of n tokens shares with any set that is like it."""
    return n // 20 + 1


def signatures(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Index keys of a set: single rare tokens, then neighbouring pairs of frequent ones.

    Sets of up to three tokens are like no other set but their copies and get none.
    """
    n = len(tokens)
    if n <= 3:
        return tokens[:0]
    at = np.searchsorted(frequent, tokens)
    often = np.zeros(n, bool)
    inside = at < len(frequent)
    often[inside] = frequent[at[inside]] == tokens[inside]
    single = n // 5 + needed(n)
    rare = tokens[~often]
    if len(rare) >= single:
        return rare[:single]
    rest = tokens[often][: 2 * n // 5 + needed(n) - len(rare) + 1]
    return np.concatenate([rare, mix(rest[:-1] * np.uint64(0xA24BAED4963EE407) + rest[1:] * np.uint64(0x9FB21C651E98DF25))])


def _index(frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()  # copies within a task are indexed once
        for batch in batches:
            for part, texts in pieces(batch):
                ids, least, keys = [], [], []
                for doc_id, words in zip(part.column("doc_id").to_pylist(), word_hashes(texts), strict=True):
                    tokens = shingles(words)
                    mark = _digest(tokens)
                    if mark not in met:
                        met.add(mark)
                        found = signatures(tokens, frequent)
                        if len(found):
                            ids.append(doc_id)
                            least.append(needed(len(tokens)))
                            keys.append(found.view(np.int64))
                if ids:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(least, pa.int32()), lists(keys)], names=["doc_id", "least", "keys"]
                    )

    return run


def _sets(wanted: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = passes(wanted, batch.column("h").to_numpy())
            for part, texts in pieces(batch.filter(pa.array(hit))):
                sets = [shingles(w).view(np.int64) for w in word_hashes(texts)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), lists(sets)], names=["doc_id", "n", "tokens"]
                )

    return run


def _possible(x: str, y: str) -> F.Column:
    """Length and position bounds of a pair of entries of one token, as if it were the first token they share.

    A pair that is alike passes at its first shared token, so it may be dropped at any other.
    """
    return F.expr(
        f"5 * least({x}.n, {y}.n) >= 4 * greatest({x}.n, {y}.n) and 9 * least({x}.c - {x}.pos, {y}.c - {y}.pos) >= 4 * ({x}.n + {y}.n)"
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (
        pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", both.alias("o")).where("180 * o >= 80 * (na + nb)").select("a", "b")
    )


def _ordered(one: str, two: str) -> list[F.Column]:
    return [F.least(one, two).alias("a"), F.greatest(one, two).alias("b")]


def links(sets: DataFrame) -> DataFrame:
    """Links (a, b) that join the same documents as all links of ``sets`` (doc_id, n, tokens) do.

    First every indexed document is compared with one document of each key it stands under, the one with the
    fewest tokens of its own. Then pairs that are still in different components are compared, all that pass the
    bounds; pairs inside a component can't change it and aren't made.
    """
    tokens = sets.select("doc_id", F.explode("tokens").alias("token"))
    # counts are stored before they are joined back: then both sides of each join are plain exchanges, and adaptive execution
    # splits a hot token; beside an aggregate of the same stage it would not
    spread = stored(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "spread")
    own = (
        tokens.join(spread, "token")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
    )
    entries = stored(
        sets.select("doc_id", "n")
        .join(own, "doc_id")
        .select("doc_id", "n", F.size("shared").alias("c"), "shared")
        .where("n - c <= n div 5")  # else too many tokens stand in no other set
        .select("doc_id", "n", "c", F.posexplode(F.expr("slice(shared, 1, cast(n div 5 - (n - c) + 1 as int))")).alias("pos", "t"))
        .select("doc_id", "n", "c", "pos", F.col("t.token").alias("token")),
        "entries",
    )
    pivot = stored(entries.groupBy("token").agg(F.min(F.struct(F.expr("n - c").alias("u"), "doc_id", "n", "c", "pos")).alias("p")), "pivots")
    stars = stored(
        entries.alias("e")
        .join(pivot.select("token", "p.*").alias("p"), "token")
        .where(F.expr("e.doc_id <> p.doc_id") & _possible("e", "p"))
        .select(*_ordered("e.doc_id", "p.doc_id"))
        .distinct(),
        "stars",
    )
    first = stored(_verified(stars, sets), "links")
    labels = components(first)
    placed = stored(
        entries.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id")),
        "placed",
    )
    torn = stored(
        placed.groupBy("token", "label")
        .agg(F.count("*").alias("k"))
        .groupBy("token")
        .agg(F.max(F.struct("k", "label")).getField("label").alias("top"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select("token", "top"),
        "torn",
    )
    open_keys = stored(placed.join(torn, "token"), "open")
    rest = (
        open_keys.where("label <> top")
        .alias("x")
        .join(open_keys.alias("y"), "token")
        .where(F.expr("x.label <> y.label and (y.label = y.top or x.doc_id < y.doc_id)") & _possible("x", "y"))
        .select(*_ordered("x.doc_id", "y.doc_id"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    return first.unionByName(stored(_verified(rest, sets), "links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked doc_id, itself included).

    Only ``doc_id`` and ``text`` of ``docs`` are read, so other columns may have any names. A null or empty text
    has no shingles and is linked with nothing. Equal texts, and texts with the same shingles, are
    linked. A doc_id names a document: rows that repeat it are rows of that document. A null doc_id gives a row
    with a null component_id that takes no part. An empty table gives no rows.
    """
    spark = small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = stored(docs.mapInArrow(_profile, _PROFILE), "profile")
    profile = seen.where("token is null").select("doc_id", "n", "digest")
    total = profile.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    least = max(total // FREQUENT, OFTEN - 1)  # leaves FREQUENT tokens at most
    often = seen.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen")).where(F.col("seen") > least).select("token")
    frequent = np.sort(often.toPandas()["token"].to_numpy(np.int64).view(np.uint64))

    known = docs.where("doc_id is not null")
    index = stored(known.mapInArrow(_index(frequent), "doc_id long, least int, keys array<long>"), "index")
    keys = index.select("doc_id", "least", F.explode("keys").alias("key"))
    common = stored(keys.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low <> high").select("key"), "common")
    meeting = (
        keys.join(common, "key")
        .groupBy("doc_id")
        .agg(F.count("*").alias("n"), F.min("least").alias("least"))
        .where("n >= least")
        .select("doc_id")
    )
    classes = stored(
        profile.where("doc_id is not null and n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n")), "classes"
    )
    members = profile.where("doc_id is not null and n > 3").select("doc_id", "digest")
    met = stored(members.join(meeting, "doc_id", "left_semi").select("digest").distinct().join(classes, "digest").select(F.col("rep").alias("doc_id")), "met")
    wanted = bit_filter(met.select(F.xxhash64("doc_id").alias("h")), "h", met.count())
    sets = stored(
        known.withColumn("h", F.xxhash64("doc_id"))
        .mapInArrow(_sets(wanted), "doc_id long, n long, tokens array<long>")
        .join(met, "doc_id", "left_semi")
        .dropDuplicates(["doc_id"]),
        "sets",
    )
    labels = components(links(sets))
    placed = classes.join(labels, classes.rep == labels.node, "left").select("digest", F.coalesce("label", "rep").alias("component_id"))
    out = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
    alone = profile.where("doc_id is null or n = 0").withColumn("component_id", F.col("doc_id"))
    return profile.where("doc_id is not null and n > 0").join(placed, "digest").select(*out).unionByName(alone.select(*out))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents that are the first of their group; rows that repeat a doc_id stay together.

    Documents without an id are kept.
    """
    others = near_duplicates(docs).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(*docs.columns)
