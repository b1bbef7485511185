"""Licence scans by a positional rare-token index (DataFrame functions only).

Templates are licence sentences with a mandatory key phrase.  The index posts every template
word (common function words left out) with its position.  Of every key phrase the ``LOOKED_UP`` index words
with the highest IDF are looked up, however many documents have them; a hit at word i of a template
word at position p votes for the template starting at word i - p.  Starts with two
votes or more are candidates, and a candidate counts when the template's key phrase stands word for
word at its place: then its looked-up words stand there too, so no such place is missed, in a corpus of
any size and with any share of licence headers.  Its score is the share of the template's words found at their places.

Two passes over the text: document frequencies of the index's words (one row per
word, about a hundred), then the scan, which stays inside the row.

Defined cases: null and empty texts have no words, no labels, score 0 and null places; rows are
judged one by one, so repeated rows, repeated or null ids are fine; ties don't arise (labels are
sets, the score a maximum); very long texts cost one sort of their votes; an empty table
gives an empty result; other columns are kept, but one named like the output is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases that give a label wherever they stand.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Fixed values: (label, template, key phrase in it), lower case, words parted by one space.
TEMPLATES = (
    ("agpl", "under the terms of the gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nd", "licensed under cc by nd 4 0", "cc by nd"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc-by", "licensed under the creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc0", "creative commons cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("lgpl", "under the terms of the gnu lesser general public license", "lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("reserved", "copyright all rights reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    # short forms, as they stand in a line of their own
    ("bsd", "released under the bsd license", "bsd license"),
    ("bsd", "released under the bsd 2 clause license", "bsd 2 clause"),
    ("bsd", "released under the bsd 3 clause license", "bsd 3 clause"),
    ("isc", "released under the isc license", "isc license"),
    ("mit", "released under the mit license", "mit license"),
    ("mpl-2.0", "released under the mozilla public license version 2 0", "mozilla public license"),
    ("mpl-2.0", "released under the mpl 2 0", "released under the mpl"),
    ("mpl-2.0", "licensed under the mpl 2 0", "licensed under the mpl"),
    ("unlicense", "released under the unlicense", "released under the unlicense"),
    ("unlicense", "licensed under the unlicense", "licensed under the unlicense"),
)
#: Words that are never looked up (they still count in scores and key phrases).
FUNCTION_WORDS = frozenset("0 1 2 4 a and any are as by for form forms from in into is it of or the this to under use v with without".split())


#: Index words of each key phrase that are looked up; as many as the votes that a candidate needs.
LOOKED_UP = 2


def template_words() -> list[tuple[str, list[str], int, int]]:
    """(label, words, first and end position of the key phrase)."""
    out = []
    for label, text, key in TEMPLATES:
        words, need = text.split(), key.split()
        at = next(k for k in range(len(words)) if words[k : k + len(need)] == need)
        out.append((label, words, at, at + len(need)))
    return out


def index_words() -> list[str]:
    return sorted({w for _, text, _ in TEMPLATES for w in text.split()} - FUNCTION_WORDS)


def words_of(text: str) -> Column:
    """Lower-cased (A to Z) words of ASCII letters, digits and characters beyond ASCII."""
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.filter(F.split(lowered, GAP), lambda x: x != "")


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def rare_words(docs: DataFrame, text: str) -> list[str]:
    """The rarest index words of every key phrase, by their documents (one row per index word comes back)."""
    present = F.array_distinct(F.filter(words_of(text), lambda x: x.isin(index_words())))
    have = docs.select(F.explode(present).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("df")).collect()
    df = {r["w"]: r["df"] for r in have}
    keys = [set(words[a:b]) - FUNCTION_WORDS for _, words, a, b in template_words()]
    return sorted({w for key in keys for w in sorted(key, key=lambda w: (df.get(w, 0), w))[:LOOKED_UP]})


def _phrase_at(w: Column, i: Column, words: list[str]) -> Column:
    ok = F.lit(True)
    for k, word in enumerate(words):
        ok = ok & F.coalesce(F.get(w, i + k) == word, F.lit(False))
    return ok


def _candidates(w: Column, at: Column, rare: list[str]) -> Column:
    """Starts (template, start) with two votes or more, from the rare words' postings."""
    posted = [(t, word, p) for t, (_, words, _, _) in enumerate(template_words()) for p, word in enumerate(words) if word in rare]
    index = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(word).alias("w"), F.lit(p).alias("p")) for t, word, p in posted])
    votes = F.flatten(
        F.transform(at, lambda i: F.transform(F.filter(index, lambda x: x["w"] == F.get(w, i)), lambda x: F.struct(x["t"].alias("t"), (i - x["p"]).alias("s"))))
    )

    def twice(z: Column) -> Column:
        first = lambda x, k: (k == 0) | (F.get(z, k - 1) != x)
        return F.filter(z, lambda x, k: first(x, k) & F.coalesce(F.get(z, k + 1) == x, F.lit(False)))

    return _let(F.array_sort(votes), twice) if posted else F.array().cast("array<struct<t:int,s:int>>")


def _verified(w: Column, found: Column) -> Column:
    """(label, start, score) of the candidates whose key phrase stands at its place."""
    known = template_words()
    table = F.array(
        *[
            F.struct(F.lit(label).alias("label"), F.array(*map(F.lit, words)).alias("words"), F.lit(a).alias("a"), F.lit(b).alias("b"))
            for label, words, a, b in known
        ]
    )

    def judge(x: Column) -> Column:
        def against(t: Column) -> Column:
            there = F.transform(t["words"], lambda word, k: (x["s"] + k >= 0) & F.coalesce(F.get(w, F.greatest(x["s"] + k, F.lit(0))) == word, F.lit(False)))
            return _let(
                there,
                lambda hit: F.struct(
                    t["label"].alias("label"),
                    x["s"].alias("start"),
                    (F.size(F.filter(hit, lambda h: h)) / F.size(hit)).alias("score"),
                    F.forall(F.slice(hit, t["a"] + 1, t["b"] - t["a"]), lambda h: h).alias("key"),
                ),
            )

        return _let(F.get(table, x["t"]), against)

    checked = F.filter(F.transform(found, judge), lambda x: x["key"])
    return F.transform(checked, lambda x: F.struct(x["label"].alias("label"), x["start"].alias("start"), x["score"].alias("score")))


def scan_licenses(docs: DataFrame, text: str = "text", out: str = "license") -> DataFrame:
    """``docs`` plus a struct: n_words, base (label and start of every base phrase), found (label, start, score)."""
    rare = rare_words(docs, text)
    looked_up = sorted({*rare, *[p.split()[0] for p in BASE]})

    def scan(w: Column) -> Column:
        at = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: F.get(w, i).isin(looked_up))
        at = F.when(F.size(w) > 0, at).otherwise(F.array().cast("array<int>"))

        def places(hits: Column) -> Column:
            base = [_base_places(w, hits, p.split(), label) for p, label in BASE.items()]
            return F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.concat(*base).alias("base"),
                _let(_candidates(w, hits, rare), lambda c: _verified(w, c)).alias("found"),
            )

        return _let(at, places)

    return docs.withColumn(out, _let(words_of(text), scan))


def _base_places(w: Column, hits: Column, words: list[str], label: str) -> Column:
    there = F.filter(hits, lambda i: _phrase_at(w, i, words))
    return F.transform(there, lambda i: F.struct(F.lit(label).alias("label"), i.cast("long").alias("start")))


def digest(out: str = "license") -> list[Column]:
    """The scan as plain columns."""
    starts = F.col(f"{out}.base.start")
    base = F.col(f"{out}.base.label")
    every = F.concat(base, F.col(f"{out}.found.label"))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return [
        F.col(f"{out}.n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(every).alias("labels"),
        F.when(F.size(base) > 0, F.lit(1.0)).otherwise(F.coalesce(F.array_max(F.col(f"{out}.found.score")), F.lit(0.0))).alias("score"),
    ]
