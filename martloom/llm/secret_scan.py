"""Secret scans: candidate strings judged by a random forest.

A candidate is whatever a secret's name is given, a run of twelve or more key characters with a digit in it, or one of sixteen or
more without a digit whose letters change case often or stand in long rows of consonants. Its features are its length and mix of characters, how usual its
character transitions are in prose, how much of it dictionary words cover, the path it stands under, and the words
next to it. The forest is trained on labelled findings and takes out false positives: card and phone
numbers, digests, identifiers, words run together.

Findings may come with labels from review. Without them ``label_findings`` marks what is beyond doubt: published key formats and
assignments to a secret's name as secrets, checked numbers, identifiers and named digests as none; all others stay open and are left to
the forest. What decides those labels (the exact format, the name) is not itself a feature.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import named
from martloom.session import materialize

_NAME = r"(?:pass(?:word|wd)?|pwd|secret|token|api_?key|auth|credential)s?"
_GIVEN = rf"(?<=[=:]\s{{0,16}}[\"']?)(?<=(?i:{_NAME}[\"']?\s{{0,16}}[=:]\s{{0,16}}"  # a look back must have a greatest length
ASSIGNED = (
    rf"{_GIVEN}\"))[^\"\r\n]+(?=\")|{_GIVEN}'))[^'\r\n]+(?=')"
    rf"|{_GIVEN}[\"']?))(?![=:])[^\s\"']*[^\s\"',;)\]}}>.]"
)
# without a digit: four changes of case, or six consonants in a row
MIXED = r"(?<![A-Za-z0-9+/_\-])(?:(?=(?:[A-Z+/_\-]*[a-z+/_\-]+[A-Z]){4})|(?=[A-Za-z]*?(?i:[bcdfghj-np-tv-xz]{6})))[A-Za-z+/_\-]{16,}+(?![0-9])=*"
PLAIN = rf"(?<![A-Za-z0-9+/_\-])(?=[A-Za-z+/_\-]*+[0-9])[A-Za-z0-9+/_\-]{{12,}}+=*|{MIXED}"
CANDIDATE = f"{ASSIGNED}|{PLAIN}"
ANY_NAME = rf"(?i){_NAME}[\"']?\s*[=:]"  # looking back at every character is dear: only in texts with a name that is given something
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
NEAR = 64  # characters on either side that are read for neighbouring words

SECRET_FORMAT = "^(?:AKIA[0-9A-Z]{16}|ASIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|AIza[0-9A-Za-z_-]{35}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[0-9A-Za-z]{24,})$"
SECRET_NAME = rf"(?i){_NAME}[\"']?\s*[=:]\s*[\"']?$"
DIGEST_NAME = r"(?i)(?:sha-?(?:1|256|512)?|md5|commit|checksum|digest|revision|rev|etag|integrity)\W{0,3}$"
UUID = "^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
KEY_WORDS = "key token secret password passwd pwd pass api auth access bearer credential private signature".split()
ID_WORDS = "id sha md5 commit hash checksum uuid version build order invoice phone card account ref isbn call number".split()
TEST_PATH = r"(?i)(?:^|[/_.\-])(?:tests?|examples?|samples?|mocks?|fixtures?|docs?|demo)(?:[/_.\-]|$)"
CONFIG_PATH = r"(?i)\.(?:env|ya?ml|json|ini|cfg|conf|toml|properties|pem|key|tf)$"

FEATURES = (
    "length", "digits", "uppers", "signs", "hexes", "variety", "switches", "usual", "covered", "path_depth", "path_test", "path_config",
    "key_word", "id_word", "assigned", "quoted", "prose_before", "prose_after",
)


def _class(c: Column) -> Column:
    return F.instr(F.lit(LETTERS), c) * (c != "").cast("int")


def transitions(prose: DataFrame, column: str = "text") -> list[float]:
    """Log-probabilities of one character behind another, 37 by 37 classes (letters, digits, all else), over all rows.

    One pass that ends in at most 1,369 counts; unseen transitions get a small share.
    """
    chars = F.split(F.lower(F.coalesce(F.col(column).cast("string"), F.lit(""))), "")
    pairs = F.zip_with(chars, F.slice(chars, 2, F.greatest(F.size(chars), F.lit(1))), lambda a, b: _class(a) * 37 + F.coalesce(_class(b), F.lit(0)))
    counts = {r.p: r.n for r in prose.select(F.explode(pairs).alias("p")).groupBy("p").agg(F.count("*").alias("n")).collect()}
    out = []
    for a in range(37):
        row = [counts.get(a * 37 + b, 0) + 0.1 for b in range(37)]
        total = sum(row)
        out += [math.log(x / total) for x in row]
    return out


def dictionary(prose: DataFrame, column: str = "text") -> DataFrame:
    """Distinct lower-cased words of three letters or more."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(column).cast("string"), F.lit(""))), F.lit("[a-z]{3,}"), F.lit(0))
    return prose.select(F.explode(words).alias("word")).distinct()


def _usual(text: Column, table: list[float]) -> Column:
    """Mean log-probability of the text's transitions; that of a usual word for texts of under two characters."""
    weights = F.array(*map(F.lit, table))
    chars = F.filter(F.split(F.lower(text), ""), lambda c: c != "")
    each = F.zip_with(chars, F.slice(chars, 2, F.greatest(F.size(chars), F.lit(1))), lambda a, b: F.get(weights, _class(a) * 37 + _class(F.coalesce(b, F.lit("")))))
    n = F.size(chars)
    total = F.aggregate(F.slice(each, 1, F.greatest(n - 1, F.lit(0))), F.lit(0.0), lambda s, x: s + x)
    return F.when(n > 1, total / (n - 1)).otherwise(F.lit(-2.0))


def candidates(files: DataFrame, path: str = "path") -> DataFrame:
    """doc_id, path, place (number in the text), start, value, before, after of every candidate in ``text``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def cut(pattern: str) -> Column:
        both = named(values=F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps=F.split(text, pattern, -1))
        return F.when(text.rlike(pattern), both)

    listed = F.when(text.rlike(ANY_NAME), cut(CANDIDATE)).otherwise(cut(PLAIN))
    rows = files.select("doc_id", F.col(path).cast("string").alias("path"), listed.alias("x")).where("x is not null")
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("starts"))
    lengths = F.zip_with("x.values", F.slice("x.gaps", 1, F.size("x.values")), lambda v, g: named(g=F.length(g), v=F.length(v)))
    starts = F.aggregate(
        lengths,
        start,
        lambda s, p: named(at=s["at"] + p["g"] + p["v"], starts=F.concat(s["starts"], F.array(s["at"] + p["g"]))),
        lambda s: s["starts"],
    )
    return (
        rows.select("doc_id", "path", "x.gaps", starts.alias("starts"), F.posexplode("x.values").alias("place", "value"))
        .select(
            "doc_id",
            "path",
            "place",
            F.get("starts", F.col("place")).alias("start"),
            "value",
            F.expr(f"right(get(gaps, place), {NEAR})").alias("before"),
            F.expr(f"left(get(gaps, place + 1), {NEAR})").alias("after"),
        )
    )


def features(found: DataFrame, prose: DataFrame, column: str = "text") -> DataFrame:
    """``found`` with the columns FEATURES. ``prose`` gives transitions and dictionary.

    Dictionary words are met through the letter runs of distinct values, so a value that stands in many files is met once.
    """
    table = transitions(prose, column)
    value, n = F.col("value"), F.length("value")
    runs = found.select("value").distinct().select("value", F.explode(F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"))
    covered = runs.join(dictionary(prose, column), "word").groupBy("value").agg(F.sum(F.length("word")).alias("letters"))
    count = lambda pattern: F.regexp_count(value, F.lit(pattern)) / n
    word_before = F.lower(F.regexp_extract("before", r"([A-Za-z_]+)[^A-Za-z_]*$", 1))
    word_after = F.lower(F.regexp_extract("after", r"^[^A-Za-z_]*([A-Za-z_]+)", 1))
    listed = lambda words: word_before.rlike("(?:^|_)(?:" + "|".join(words) + ")s?(?:_|$)").cast("double")
    p = F.coalesce("path", F.lit(""))
    return (
        found.join(covered, "value", "left")
        .withColumns(
            {
                "length": F.least(n, F.lit(400)).cast("double"),
                "digits": count("[0-9]"),
                "uppers": count("[A-Z]"),
                "signs": count("[^A-Za-z0-9]"),
                "hexes": count("[0-9a-f]"),
                "variety": F.size(F.array_distinct(F.split("value", ""))) / n,
                "switches": F.regexp_count(value, F.lit("(?:[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z]))")) / n,
                "usual": _usual(value, table),
                "covered": F.least(F.lit(1.0), F.coalesce("letters", F.lit(0)) / n),
                "path_depth": F.regexp_count(p, F.lit("/")).cast("double"),
                "path_test": p.rlike(TEST_PATH).cast("double"),
                "path_config": p.rlike(CONFIG_PATH).cast("double"),
                "key_word": listed(KEY_WORDS),
                "id_word": listed(ID_WORDS),
                "assigned": F.col("before").rlike(r"[=:]\s*[\"']?$").cast("double"),
                "quoted": F.col("before").rlike(r"[\"']$").cast("double"),
                "prose_before": _usual(word_before, table),
                "prose_after": _usual(word_after, table),
            }
        )
        .drop("letters")
    )


def label_findings(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1 beyond doubt a secret, 0 beyond doubt none, null open."""
    v = F.col("value")
    digits = F.regexp_replace(v, "[^0-9]", "")
    none = (
        v.rlike("^[0-9\\-]+$") | v.rlike(UUID) | F.col("before").rlike(DIGEST_NAME) | v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}") | (F.col("covered") >= 0.6)
    ) | (v.rlike("^[0-9]{13,19}$") & F.call_function("luhn_check", digits))
    secret = v.rlike(SECRET_FORMAT) | F.col("before").rlike(SECRET_NAME)
    return found.withColumn("label", F.when(none, 0.0).when(secret, 1.0))


def _vectors(found: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found)


def train(labelled: DataFrame, sample: int = 4000, trees: int = 30, depth: int = 8) -> RandomForestClassificationModel | float:
    """A forest from findings with FEATURES and ``label`` (null: not used); ``sample`` rows of each label by hash of the value at most.

    Equal findings of many copies count once. With one label only, that label; with none, 0.
    """
    known = labelled.where("label is not null").dropDuplicates(["value", "before", "after"])
    order = F.xxhash64("value", "before", "after")
    picked = known.where("label = 1").orderBy(order).limit(sample).unionByName(known.where("label = 0").orderBy(order).limit(sample))
    rows = materialize(picked.select(*FEATURES, "label", order.alias("o")).repartition(1).sortWithinPartitions("o"), "findings")
    labels = sorted(r.label for r in rows.select("label").distinct().collect())
    if len(labels) < 2:
        return labels[0] if labels else 0.0
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, featuresCol="features", labelCol="label", seed=1).fit(_vectors(rows))


def scan(files: DataFrame, prose: DataFrame, path: str = "path", prose_column: str = "text") -> DataFrame:
    """One row for each candidate: doc_id, place, start, value, label (null: open), score, is_secret.

    Texts that are null, empty or without candidates give no rows; null and repeated ids are carried along, rows that
    repeat give repeated findings. Only doc_id, text and ``path`` are read.
    """
    # stored first: features read them twice, and finding them is the dearest scan
    found = materialize(candidates(files, path), "found")
    marked = label_findings(materialize(features(found, prose, prose_column), "candidates"))
    model = train(marked)
    if isinstance(model, float):
        scored = marked.withColumn("score", F.lit(model))
    else:
        scored = model.transform(_vectors(marked)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", "place", "start", "value", "label", "score", (F.col("score") >= 0.5).alias("is_secret"))
