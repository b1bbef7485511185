"""Ranked search against a plain loop; bounds hold; pruning takes place."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from brook.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k=50):
    tfs = [(d, Counter(terms(t))) for d, t in docs]
    tfs = [(d, c) for d, c in tfs if c]
    n_docs, total = len(tfs), sum(sum(c.values()) for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in tfs:
            m = 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text))
                if t in c
            )
            if score > 0:
                found.append((-score, d is None, d, score))
        for rank, (_, _, d, score) in enumerate(sorted(found, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1):
            out.append((item, rank, d, score))
    return sorted(out, key=str)


def _rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(400)] + ["Éa", "日本", "x9"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    docs = [(i * 3, " ".join(rng.choices(vocabulary, weights, k=rng.choice([3, 20, 90, 400])))) for i in range(700)]
    docs += [(5, None), (6, ""), (7, " .,! "), (None, "w3 w9 w9 W3"), (1, docs[0][1]), (0, docs[0][1]), (0, docs[0][1])]
    docs.append((10_000, "w1 w2 " * 20_000 + " ".join(f"u{i}" for i in range(20_000))))
    items = [(i, " ".join(rng.choices(vocabulary, k=12))) for i in range(25)] + [(25, None), (26, "..."), (27, "nowhere"), (None, "w1 x9"), (3, "w1 x9")]
    return docs, items


def _frames(spark, corpus):
    docs, items = corpus
    return (
        spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, terms string").repartition(3),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, item int"),
    )


@pytest.mark.parametrize("per_block", [500, 7])
def test_equals_a_plain_loop(spark, corpus, per_block):
    docs, items = _frames(spark, corpus)
    got = lexical.search(lexical.build_index(docs), items, items_per_block=per_block)
    assert _rows(got) == brute_force(*corpus)


def test_small_k_and_many_tasks(spark, corpus):
    docs, items = _frames(spark, corpus)
    got = lexical.search(lexical.build_index(docs.repartition(23)), items, k=3)
    assert _rows(got) == brute_force(*corpus, k=3)


def test_empty_tables(spark, corpus):
    docs, items = _frames(spark, corpus)
    assert lexical.search(lexical.build_index(docs.limit(0)), items).collect() == []
    assert lexical.search(lexical.build_index(docs), items.limit(0)).collect() == []


def test_bounds_hold_and_exclude(corpus):
    docs, items = corpus
    pool = []
    for d, t in docs:
        c = Counter(lexical.terms_of(t))
        if c:
            tf = np.array(list(c.values()))
            hashes = np.array([lexical.term_hash(x) for x in c], dtype=np.uint64)
            pool.append((sum(int((tf >= v).sum()) for v in lexical.levels(int(tf.max()))), d, int(tf.sum()), list(c), tf, hashes))
    block_items = lexical.Items(items[:25])
    weight = np.full(len(block_items.hashes), 1000)
    n, total = len(pool), sum(p[2] for p in pool)
    kept = every = 0
    for block in lexical._blocks(pool):
        norm = lexical.lengths_norm(block["n"], n, total)
        bound = lexical.upper_bounds(block_items, weight, norm, block["m"], block["top"], block["slices"])
        exact = lexical.exact_scores(block_items, weight, norm, np.arange(len(norm)), block["distinct"], block["terms"], block["tfs"])
        assert (bound >= exact).all()
        tenth = np.sort(exact, axis=1)[:, -min(10, exact.shape[1])][:, None]
        kept, every = kept + (bound >= tenth).sum(), every + exact.size
    assert kept < every / 2


def test_terms_are_the_pattern_s():
    text = "Ab9_cd-ÉÀ [x]`y{z}\x7f~日本\U0001f600q\x80"
    assert [t.decode() for t in lexical.terms_of(text)] == terms(text)
