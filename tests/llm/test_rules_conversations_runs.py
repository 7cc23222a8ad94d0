"""Quality rules, conversation repair and periodic runs against brute force and on odd input."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from martloom.llm import conversations, periodic_runs, quality, quality_rules, queries, token_counts
from martloom.session import materialize, prepare, work_path

LONG = "lorem ipsum dolor sit amet consectetur " * 40_000
EDGE = [
    (1, "one two three four five six seven", "a"),
    (1, "one two three four five six seven", "a"),
    (2, None, "b"),
    (3, "", None),
    (4, " \n\t\x0b", "c"),
    (None, "no id here at all today", None),
    (None, None, None),
    (5, LONG + "tail", "a"),
    (6, "a a a b " * 30, "c"),
    (7, "naïve ünïcode… 🙂 …\n- x\n- x\n  * y ...\n" * 20, "d"),
    (8, "x y z " * 60, "nbsp is no blank"),
]
CLASHING = ("n_words", "runs", "rejected_by", "copies", "digest", "is_row", "part", "h", "kept", "_words")


def documents(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASHING)))


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


# --- quality rules --------------------------------------------------------------------


def measures(text):
    text = text or ""
    words = words_of(text)
    lines = [x for x in text.split("\n") if words_of(x)]
    seen, places = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            places |= {i + k for i in at for k in range(3)}
    n = len(words)
    values = {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(places),
        "n_lines": len(lines),
        "n_capitals": sum("A" <= c <= "Z" for c in text),
        "n_exclaims": text.count("!"),
        "n_lettered": sum(any(c.isascii() and c.isalpha() or not c.isascii() for c in w) for w in words),
        "n_bullets": sum(x.lstrip(" \t\n\x0b\x0c\r")[0] in "-*•" for x in lines),
        "n_ellipses": sum(x.rstrip(" \t\n\x0b\x0c\r").endswith(("...", "…")) for x in lines),
    }
    failed = [eval(r.fails.replace("AND", "and").replace("OR", "or"), {}, values) for r in quality_rules.RULES]  # noqa: S307
    return {**{k: values[k] for k in quality_rules.BASE}, "base_failed": any(failed[:2]), "kept": not any(failed)}


def test_rules_agree_with_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got = queries.op11_quality_rules(spark, SF_DIR).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = con.execute(quality_rules.ORACLE).df().sort_values("doc_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want[got.columns], check_dtype=False)


def test_rules_agree_with_brute_force_on_odd_texts(spark):
    rng = random.Random(3)
    made = [(100 + k, "".join(rng.choices(["ab ", "AB! ", "x#y ", "\n", "…", "- ", "cd ef gh ", "1 2 3 "], k=rng.randint(0, 200))), "m") for k in range(60)]
    rows = EDGE + made
    got = quality_rules.report(documents(spark, rows)).collect()
    names = [*quality_rules.BASE, "base_failed", "kept"]
    key = lambda values: sorted(values, key=repr)
    assert key([(r.doc_id, *(r[n] for n in names)) for r in got]) == key([(i, *(measures(t)[n] for n in names)) for i, t, _ in rows])


def test_cascade_puts_the_rule_with_most_rejections_for_its_cost_first_and_keeps_the_verdict(spark):
    docs = documents(spark, EDGE)
    cheap = quality_rules.Rule("cheap", "n_symbols > 1000000", ("n_symbols",))
    strict = quality_rules.Rule("strict", "n_words < 50", ("n_words",))
    assert [r.name for r in quality_rules.order(docs.cache(), [cheap, strict], {})] == ["strict", "cheap"]
    for rules in (quality_rules.RULES, quality_rules.RULES[::-1]):
        named = docs.withColumn("r", quality_rules.cascade(rules, {})).select("doc_id", "r").collect()
        assert sorted((r.r is None) for r in named) == sorted(measures(t)["kept"] for _, t, _ in EDGE)
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns and kept.count() == sum(measures(t)["kept"] for _, t, _ in EDGE)


def test_a_rule_behind_the_rejecting_one_is_not_evaluated(spark):
    fails = quality_rules.Rule("fails", "n_words >= 0", ("n_words",))
    raises = quality_rules.Rule("raises", "raise_error(concat('evaluated', n_words)) is null", ("n_words",))
    named = documents(spark, EDGE).select(quality_rules.cascade([fails, raises], {}).alias("r")).collect()
    assert {r.r for r in named} == {"fails"}


def test_rules_run_without_python_and_take_an_empty_table(spark):
    empty = quality_rules.report(documents(spark, []))
    assert empty.collect() == []
    plan = quality_rules.report(documents(spark, EDGE))._jdf.queryExecution().executedPlan().toString()
    assert not re.findall(r"\w*(?:EvalPython|InPandas|InArrow)\w*", plan)


# --- conversations --------------------------------------------------------------------


def cheapest(rows):
    """Rows (turn, role, text) in order -> faults, illegal pairs, cost, edits and result by uniform-cost search."""
    seen, faults = set(), []
    for _, role, text in rows:
        core = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not core else "d" if (role, text) in seen else "t" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, edits, i, last, result = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return faults, illegal, cost, edits, result

        def fits(c, last=last):
            return {"s": last == "", "u": last != "u", "a": last == "u"}.get(c, False)

        for role in ("user", "assistant"):
            if fits(role[0]):
                heapq.heappush(heap, (cost + 2, edits + "I", i, role[0], (*result, (role, ""))))
        if i < len(rows):
            _, own, text = rows[i]
            heapq.heappush(heap, (cost + 3, edits + "D", i + 1, last, result))
            if faults[i] in ("", "t"):
                late = int(faults[i] == "t")
                if fits(own[:1]):
                    heapq.heappush(heap, (cost + late, edits + "K", i + 1, own[:1], (*result, (own, text))))
                for role in ("user", "assistant"):
                    if fits(role[0]):
                        heapq.heappush(heap, (cost + 2 + late, edits + "R", i + 1, role[0], (*result, (role, text))))


def audited(rows, damage=True):
    by = {}
    for conv, turn, role, text in rows:
        held = by.setdefault(conv, [])
        d = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 19
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if d == 1 else text.translate(str.maketrans("", "", ".!?")) if d == 2 else text
        held += [(turn, "user" if d == 4 else role, text)] * (0 if d == 0 else 2 if d == 3 else 1)
    out, results = {}, {}
    for conv, held in by.items():
        digest = lambda r: hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()  # noqa: E731, S324
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], digest(r)))
        turns = [t for t, _, _ in held if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults, illegal, cost, edits, result = cheapest(held)
        whole = "\n".join(f"{r}:{t}" for r, t in result)
        out[conv] = (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, edits, hashlib.sha256(whole.encode()).hexdigest())
        results[conv] = list(result)
    return out, results


def made_conversations(rng, n):
    texts = ["Hi.", "no end", "Yes!", "", "  \n", "what?", "ok. ", "a.b", "é…", None]
    roles = ["user", "assistant", "system", "tool", None, "", "u2", "User"]
    rows = []
    for conv in [*range(n), None]:
        for k in range(rng.choice([0, 1, 2, 3, 5, 9, 30])):
            role = rng.choice(roles) if rng.random() < 0.4 else ("user", "assistant")[k % 2]
            rows.append((conv, rng.choice([None, k, k, k, k // 2, k + 3]), role, rng.choice(texts) if rng.random() < 0.6 else f"text {k}."))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("piece", [1 << 18, 5])
def test_repairs_agree_with_uniform_cost_search(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "PIECE", piece)
    rng = random.Random(piece)
    rows = made_conversations(rng, 150)
    # one conversation holds most rows: one turn many times, one text in many turns, one very long text
    rows += [(900, k // 40, "user", "same.") for k in range(1500)]
    rows += [(900, 100 + k, rng.choice(["user", "assistant"]), f"w {k}" + rng.choice(["", "."])) for k in range(800)] + [(900, 950, "user", LONG)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("copies", "digest", "is_row", "part", "edits")})
    got = {r.conv_id: tuple(r[1:]) for r in conversations.report(df).collect()}
    assert got == audited(rows)[0]


def test_repaired_rows_are_those_of_the_cheapest_repair(spark):
    rows = made_conversations(random.Random(8), 60)
    df = spark.createDataFrame(rows, SCHEMA)
    want, results = audited(rows, damage=False)
    found = {}
    for r in conversations.repair(df).orderBy("conv_id", "position").collect():
        assert r.position == len(found.setdefault(r.conv_id, []))
        found[r.conv_id].append((r.role, r.text))
    assert found == {c: r for c, r in results.items() if r}
    assert {r.conv_id: tuple(r[1:]) for r in conversations.audit(df).collect()} == want
    for kept in found.values():
        assert re.fullmatch("s?(ua)+", "".join(role[0] for role, _ in kept))


def test_powers_of_runs_equal_single_steps():
    behind = conversations.AT_END
    for symbol in range(9):
        slow = behind
        for n in range(1, 40):
            slow = conversations._apply(conversations._power(symbol, 0), slow)
            assert conversations._over_run(symbol, n, behind) == slow
            assert conversations._apply(conversations._matrix([[symbol, n]]), behind) == slow


def test_conversations_without_rows(spark):
    assert conversations.report(spark.createDataFrame([], SCHEMA)).collect() == []
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    (row,) = conversations.report(spark.createDataFrame([(lost, 0, "user", "Hi.")], SCHEMA)).collect()
    assert tuple(row) == (lost, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_registered_conversations_agree_with_brute_force(spark):
    rows = pd.read_parquet(f"{SF_DIR}/conversations.parquet")[["conv_id", "turn", "role", "text"]].itertuples(index=False, name=None)
    got = {r.conv_id: tuple(r[1:]) for r in queries.op12_conversations(spark, SF_DIR).collect()}
    assert got == audited(rows)[0]


# --- periodic runs --------------------------------------------------------------------


def brute_runs(w):
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            stretch = w[i : j + q]
            if len(stretch) >= max(6, 4 * q) and not any(stretch[k:] == stretch[:-k] for k in range(1, q)):
                out.append((i, len(stretch), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def reported(doc_id, text):
    w = words_of(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(w)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *top, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


@pytest.mark.parametrize("seed", range(4))
def test_runs_agree_with_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(200):
        texts = []
        for _ in range(rng.randint(1, 6)):
            letters = "abcdefgh"[: rng.choice([1, 2, 2, 3, 5])]
            w = rng.choices(letters, k=rng.choice([0, 1, 3, 6, 10, 30, 60]))
            for _ in range(rng.randint(0, 3)):
                unit, at = rng.choices(letters, k=rng.randint(1, 6)), rng.randint(0, len(w))
                w[at:at] = (unit * 9)[: rng.randint(1, 50)]
            texts.append(w)
        assert periodic_runs.find(texts) == [brute_runs(w) for w in texts]


def test_runs_of_very_long_texts():
    assert periodic_runs.find([["a"] * 100_000, ["a", "b", "c"] * 40_000 + ["x"]]) == [[(0, 100_000, 1)], [(0, 120_000, 3)]]
    rng = random.Random(1)
    assert periodic_runs.find([[f"w{rng.randrange(50_000)}" for _ in range(200_000)]]) == [[]]


def test_reported_runs_agree_with_brute_force(spark):
    given = pd.read_parquet(f"{SF_DIR}/documents.parquet")[["doc_id", "text"]].itertuples(index=False, name=None)
    got = sorted(tuple(r) for r in queries.op13_periodic_runs(spark, SF_DIR).collect())
    assert got == sorted(reported(i, t) for i, t in given)
    key = lambda rows: sorted(rows, key=repr)
    short = [r for r in EDGE if r[0] != 5]
    assert key(tuple(r) for r in periodic_runs.report(documents(spark, short)).collect()) == key(reported(i, t) for i, t, _ in short)
    (long,) = periodic_runs.collapse(documents(spark, [r for r in EDGE if r[0] == 5])).collect()
    assert [tuple(r) for r in long.runs] == [(0, 240_000, 6)] and long.collapsed == "lorem ipsum dolor sit amet consectetur tail"
    assert periodic_runs.report(documents(spark, [])).collect() == []


# --- hot tokens of the n-gram join ------------------------------------------------------


def test_joins_with_a_hot_token_are_split(spark):
    """A third of all rows on one token: the join with the tokens' own counts splits it."""
    prepare(spark)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    held = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        n = 90_000
        path = work_path(spark, "hot-sets")
        token = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.xxhash64(F.col("id") - F.col("id") % 6))
        spark.range(n).select(F.col("id").alias("doc_id"), F.array(token.cast("long")).alias("tokens")).write.parquet(path)
        tokens = spark.read.parquet(path).select("doc_id", F.explode("tokens").alias("token"))
        counts = materialize(tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "spread")
        joined = tokens.join(counts, "token")
        assert len(joined.collect()) == n
        final = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert "skew=true" in final
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- scores and counts of whole texts ----------------------------------------------------


def naive_probability(net, text):
    """One window after another."""
    w = {k: v.astype(np.float64) for k, v in net.w.items()}
    padded = np.frombuffer(text + b"\0" * ((len(text) // quality.BLOCK + 1) * quality.BLOCK - len(text) + quality.WIDTH), np.uint8)
    n = len(text) // quality.BLOCK + 1
    answers = [w["embed"][padded[k : k + quality.WIDTH]].reshape(-1) @ w["filter"] for k in range(n * quality.BLOCK)]
    chunks = []
    for start in range(0, max(1, n - quality.BLOCKS + quality.STRIDE), quality.STRIDE):
        some = answers[start * quality.BLOCK : min(start + quality.BLOCKS, n) * quality.BLOCK]
        chunks.append(np.maximum(np.max(some, 0) + w["bias"], 0))
    x = np.concatenate([np.max(chunks, 0), np.min(chunks, 0), np.mean(chunks, 0)])
    z = np.maximum(x @ w["hidden"] + w["hidden_bias"], 0) @ w["out"] + w["out_bias"][0]
    return 1 / (1 + np.exp(-z))


def test_a_score_is_that_of_the_text_alone():
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 256, n, np.uint8).tobytes() for n in (0, 1, 57, 63, 64, 65, 127, 500, 511, 513, 3000)]
    net = quality.Network(3)
    together = net.forward(texts)["p"]
    assert np.allclose(together, [net.forward([t])["p"][0] for t in texts], atol=1e-6)
    assert np.allclose(net.forward(texts[::-1])["p"][::-1], together, atol=1e-6)
    assert np.allclose(together, [naive_probability(net, t) for t in texts], atol=1e-4)


def test_scores_do_not_depend_on_partitions_and_empty_tables_have_none(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    net = quality.train(docs, labels, 100)
    score = quality.quality_score(net)
    found = [dict(map(tuple, docs.repartition(n).select("doc_id", score(F.col("text"))).collect())) for n in (1, 7)]
    assert max(abs(found[0][k] - found[1][k]) for k in found[0]) < 1e-5
    assert quality.score_documents(docs.limit(0), labels).collect() == []
    repeated = quality.score_documents(docs.limit(5).union(docs.limit(5)), labels.limit(0))
    assert repeated.count() == 10 and {r.score for r in repeated.collect()} == {0.5}


def test_token_counts_of_very_long_texts(spark):
    from tokenizers import Tokenizer

    encoder = queries.encoder()
    library = Tokenizer.from_str(encoder.content)
    rows = [(1, LONG, "a"), (2, LONG[::-1] + "<|endoftext|>", "a"), (3, None, "a"), (3, "", "a")]
    got = sorted((r.doc_id, r.n_tokens, r.over_limit) for r in token_counts.count_documents(documents(spark, rows), encoder).collect())
    want = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in rows]
    assert got == [(i, n, n > 1024) for (i, _, _), n in zip(rows, want, strict=True)]
    assert token_counts.count_documents(documents(spark, []), encoder).collect() == []
