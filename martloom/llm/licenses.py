"""License scans by a positional index of rare words.

A licence template is a list of words with their places. Words that stand in few templates (a high inverse document
frequency) are indexed with template and place. A file's indexed words are looked up, those of the highest frequency class present
deciding which templates are considered; every hit says where in the file the template would begin, and hits
that agree on template and beginning are counted together. Where enough of a template's rare words agree, its mandatory
phrases must stand word by word in their places.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import ASCII_LOWER, ASCII_UPPER, named

# The separators stand one by one: Java looks such a class up in one table, where it tries ranges one after another.
SEPARATORS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
GAP = "[" + "".join(f"\\x{ord(c):02x}" for c in SEPARATORS) + "]"
LETTER = "[^" + GAP[1:]
WORD = LETTER + "++"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
AGREE = 0.6  # share of a template's rare words, by weight, that must agree on its place
COMMON = 5  # words in the templates of more labels than this are not indexed

# label, words of the licence's name behind "gnu", of its version, its SPDX name
GNU = (
    ("gpl-2.0", "general public license", "2", "gpl 2 0"),
    ("gpl-3.0", "general public license", "3", "gpl 3 0"),
    ("lgpl-2.0", "library general public license", "2", "lgpl 2 0"),
    ("lgpl-2.1", "lesser general public license", "2 1", "lgpl 2 1"),
    ("lgpl-3.0", "lesser general public license", "3", "lgpl 3 0"),
    ("agpl-3.0", "affero general public license", "3", "agpl 3 0"),
)


def _gnu(label: str, name: str, version: str, spdx: str) -> list[tuple[str, str, tuple[str, ...]]]:
    """The file headers of the Free Software Foundation, "or later" and of one version, and the SPDX line."""
    published = f"gnu {name} as published by the free software foundation"
    notices = (f"{published} either version {version}", f"{published} version {version}", f"spdx license identifier {spdx}")
    return [(label, notice, (notice,)) for notice in notices]


# label, notice, phrases that must stand; wording as published by the licences' stewards
TEMPLATES = (
    *(notice for licence in GNU for notice in _gnu(*licence)),
    ("lgpl-2.0", "gnu library general public license version 2", ("gnu library general public license", "version 2")),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
     ("redistribution and use in source and binary forms", "with or without modification")),
    ("cc-by-4.0", "cc by 4 0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0", ("cc by nc nd 4 0",)),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0", ("cc by nc sa 4 0",)),
    ("cc-by-sa-4.0", "cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc0-1.0", "cc0 1 0 universal", ("cc0 1 0",)),
    ("cc-by-text", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("gpl-2.0", "gnu general public license version 2", ("gnu general public license", "version 2")),
    ("gpl-3.0", "gnu general public license version 3", ("gnu general public license", "version 3")),
    ("lgpl-2.1", "gnu lesser general public license version 2 1", ("gnu lesser general public license", "version 2 1")),
    ("lgpl-3.0", "gnu lesser general public license version 3", ("gnu lesser general public license", "version 3")),
    ("agpl-3.0", "gnu affero general public license version 3", ("gnu affero general public license", "version 3")),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     ("permission to use copy modify and or distribute this software",)),
    ("mit-notice", "released under the mit license", ("mit license",)),
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
     ("permission is hereby granted free of charge", "deal in the software without restriction")),
    ("mpl-2.0", "mozilla public license version 2 0", ("mozilla public license", "version 2 0")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose",
     ("this software is provided as is without any express or implied warranty",)),
)


@dataclass(frozen=True)
class Index:
    """``postings``: word -> [(template, place, weight)]; ``total`` weight and phrases with places by template.

    ``anchors``: neighbouring words of mandatory phrases. Every template has one of its own among them, the rarest.
    """

    labels: list[str]
    postings: dict[str, list[tuple[int, int, float]]]
    total: list[float]
    phrases: list[list[tuple[int, list[str]]]]
    anchors: list[str]


def build(templates=TEMPLATES) -> Index:
    """Index of templates: (label, notice, phrases); each phrase must stand in its notice."""
    words = [re.findall(WORD, notice) for _, notice, _ in templates]
    spread = Counter(w for _, w in {(label, w) for (label, _, _), ws in zip(templates, words, strict=True) for w in ws})
    n = len({label for label, _, _ in templates})
    postings: dict[str, list[tuple[int, int, float]]] = {}
    total, phrases, anchors = [], [], []
    for t, ((label, _, must), ws) in enumerate(zip(templates, words, strict=True)):
        limit = max(COMMON, min(spread[w] for w in ws))  # a template of common words keeps its rarest
        weight = 0.0
        for place, w in enumerate(ws):
            if spread[w] <= limit:
                idf = math.log(1 + n / spread[w])
                postings.setdefault(w, []).append((t, place, idf))
                weight += idf
        total.append(weight)
        own = []
        for phrase in must:
            parts = re.findall(WORD, phrase)
            at = [k for k in range(len(ws) - len(parts) + 1) if ws[k : k + len(parts)] == parts]
            if not at:
                raise ValueError(f"{label}: {phrase!r} is not in its notice")
            own.append((at[0], parts))
        phrases.append(own)
        pairs = [parts[k : k + 2] for _, parts in own for k in range(max(1, len(parts) - 1))]
        anchors.append(" ".join(min(pairs, key=lambda p: ("spdx" not in p, any(w.isdigit() for w in p), sum(spread[w] for w in p), p))))
    return Index([label for label, _, _ in templates], postings, total, phrases, sorted(set(anchors)))


def _stands(words: Column, start: Column, phrase: list[str]) -> Column:
    test = F.lit(True)
    for k, w in enumerate(phrase):
        test = test & F.coalesce(F.get(words, start + k) == w, F.lit(False))
    return (start >= 0) & test


def _places(words: Column, phrase: list[str]) -> Column:
    return F.array_compact(F.transform(words, lambda w, i: F.when((w == phrase[0]) & _stands(words, i, phrase), i)))


def _found(words: Column, index: Index) -> Column:
    """array<struct(t, share)> of the templates that stand in ``words``."""
    lookup = F.create_map(
        *(
            part
            for w, posts in sorted(index.postings.items())
            for part in (F.lit(w), F.array(*(F.struct(F.lit(t).alias("t"), F.lit(p).alias("p"), F.lit(x).alias("x")) for t, p, x in posts)))
        )
    )
    rare = sorted(index.postings)
    there = F.array_compact(F.transform(words, lambda w, i: F.when(w.isin(rare), i)))
    hits = F.array_sort(
        F.flatten(
            F.transform(
                there, lambda i: F.transform(F.try_element_at(lookup, F.get(words, i)), lambda q: named(t=q["t"], off=i - q["p"], x=q["x"]))
            )
        )
    )
    need = F.array(*(F.lit(AGREE * x) for x in index.total))
    whole = F.array(*(F.lit(x) for x in index.total))
    none = F.expr("cast(array() as array<struct<t:int,off:int,x:double>>)")
    start = named(t=F.lit(-1), off=F.lit(0), x=F.lit(0.0), ended=none)

    def ended(s: Column) -> Column:
        enough = (s["t"] >= 0) & (s["x"] >= F.get(need, s["t"]))
        return F.when(enough, F.concat(s["ended"], F.array(named(t=s["t"], off=s["off"], x=s["x"])))).otherwise(s["ended"])

    def count(s: Column, h: Column) -> Column:
        same = (s["t"] == h["t"]) & (s["off"] == h["off"])
        return named(
            t=h["t"], off=h["off"], x=F.when(same, s["x"] + h["x"]).otherwise(h["x"]), ended=F.when(same, s["ended"]).otherwise(ended(s))
        )

    agreed = F.aggregate(hits, start, count, ended)

    def check(c: Column) -> Column:
        test = F.lit(False)
        for t, own in enumerate(index.phrases):
            each = c["t"] == t
            for place, phrase in own:
                each = each & _stands(words, c["off"] + place, phrase)
            test = test | each
        return test

    return F.transform(F.filter(agreed, check), lambda c: named(t=c["t"], share=F.least(F.lit(1.0), c["x"] / F.get(whole, c["t"]))))


def count_words(text: Column) -> Column:
    """Words of a text, without an array of them: each, with the gap behind it, shrinks to one character."""
    return F.length(F.regexp_replace(F.ltrim(text, F.lit(SEPARATORS)), F.lit(f"{WORD}{GAP}*+"), F.lit("x"))).cast("long")


def concerned(text: Column, index: Index) -> Column:
    """Whether a base phrase stands in ``text``, or the anchor of a template; no template and no base phrase stands in any other text."""
    phrases = sorted({*index.anchors, *(p for p, _ in BASE)})
    there = "|".join(f"{GAP}++".join(map(re.escape, p.split())) for p in phrases)
    return text.rlike(f"(?i)(?<!{LETTER})(?:{there})(?!{LETTER})")


def scan(docs: DataFrame, index: Index | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every row.

    Base phrases are counted wherever their words stand one behind another. Templates add labels of their own; ``score`` is the largest
    share of a verified template's rare words that agree, 0.5 where only a base phrase stands, else 0. A null
    text counts as empty. Rows are scanned one by one: null and repeated ids and rows, and other columns, don't matter.
    Only texts in which an anchor or a base phrase stands are split into words.
    """
    index = index or build()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lower = F.translate(text, ASCII_UPPER, ASCII_LOWER)
    words = F.when(concerned(text, index), F.regexp_extract_all(lower, F.lit(WORD), F.lit(0))).otherwise(F.expr("cast(array() as array<string>)"))

    def row(w: Column) -> Column:
        places = [(_places(w, p.split()), label) for p, label in BASE]
        return named(
            places=F.array_sort(F.concat(*(x for x, _ in places))),
            base=F.flatten(F.array(*(F.when(F.size(x) > 0, F.array(F.lit(label))).otherwise(F.expr("cast(array() as array<string>)")) for x, label in places))),
            found=_found(w, index),
        )

    names = F.array(*(F.lit(x) for x in index.labels))
    return (
        docs.select("doc_id", count_words(text).alias("n_words"), words.alias("w"))
        .select("doc_id", "n_words", F.when(F.size("w") > 0, F.element_at(F.transform(F.array("w"), row), 1)).alias("r"))
        .select(
            "doc_id",
            "n_words",
            F.coalesce(F.size("r.places"), F.lit(0)).cast("long").alias("n_base"),
            F.array_min("r.places").cast("long").alias("first_word"),
            F.array_max("r.places").cast("long").alias("last_word"),
            F.coalesce(F.array_join(F.array_sort("r.base"), ","), F.lit("")).alias("base_labels"),
            F.coalesce(
                F.array_join(F.array_sort(F.array_distinct(F.concat("r.base", F.transform("r.found", lambda c: F.get(names, c["t"]))))), ","), F.lit("")
            ).alias("labels"),
            F.coalesce(
                F.greatest(F.array_max(F.transform("r.found", lambda c: c["share"])), F.when(F.size("r.base") > 0, F.lit(0.5))), F.lit(0.0)
            ).alias("score"),
        )
    )
