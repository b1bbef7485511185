import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brook.llm import mixing

DOCS = "doc_id long, text string, source string, size int, sk string, target string"


def docs_of(spark, n=120, seed=3):
    rng = random.Random(seed)
    rows = [(k, " ".join(f"w{j}" for j in range(rng.choice([1, 5, 30, 200]))), rng.choice(["a", "a", "a", "b", None, "ü"]), 1, "x", "y") for k in range(n)]
    rows += [(n, None, "a", 1, "x", "y"), (n + 1, "", "empty", 1, "x", "y"), (None, "no id here", "b", 1, "x", "y"), (3, "twice the same", "b", 1, "x", "y"), (3, "twice the same", "b", 1, "x", "y")]
    rows.append((n + 2, "long " * 30_000, "c", 1, "x", "y"))
    return rows, spark.createDataFrame(rows, DOCS)


def test_targets_fill_up_to_the_cap(spark):
    sizes = spark.createDataFrame([("sa", "a", 100), ("sb", "b", 1000), ("sc", "c", 900), ("n", None, 0)], "sk string, source string, source_size long")
    got = {r["sk"]: r["target"] for r in mixing.source_targets(sizes, (3, 1, 2), 1.5, 2).collect()}
    # a stops at 200, the null source at 0; 2800 remain for b and c by 1 : 2, c stops at 1800
    assert got == {"sa": 200.0, "sb": 1000.0, "sc": 1800.0, "n": 0.0}


def test_words_taken_meet_the_targets(spark):
    rows, docs = docs_of(spark)
    mixed = mixing.mix(docs, blocks=16, shards=4)
    got = mixed.collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r[0] or -1, len((r[1] or "").split())) for r in rows)
    by = {}
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == sum(s["n_words"] for s in r["segments"])
        assert all(0 <= s["shard"] < 4 and s["from_word"] + s["n_words"] <= r["size"] for s in r["segments"])
        taken, target = by.get(r["source"], (0, r["target"]))
        by[r["source"]] = (taken + r["taken"], target)
    assert all(abs(taken - target) <= 1 for taken, target in by.values())
    again = mixing.mix(docs.repartition(7), blocks=16, shards=4).collect()
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"])
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_shards_get_exact_disjoint_quotas(spark):
    quotas = spark.createDataFrame([("a", 37), ("b", 5), ("c", 0), ("d", 101)], "sk string, draws long")
    bounds = {r["sk"]: r["bounds"] for r in mixing.splitting_tree(quotas, 8, "s").collect()}
    assert {k: v[-1] for k, v in bounds.items()} == {"a": 37, "b": 5, "c": 0, "d": 101}
    sizes = np.sum([np.diff([0, *v]) for v in bounds.values()], axis=0)
    assert sizes.sum() == 143 and sizes.max() - sizes.min() <= 1


def test_draws_follow_the_hypergeometric_law(spark):
    u = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
    x = [r[0] for r in u.select(mixing.hypergeometric(F.lit(60), F.lit(20), F.lit(30), F.col("u"))).collect()]
    assert np.mean(x) == pytest.approx(10, abs=0.02)
    assert np.var(x) == pytest.approx(30 * (1 / 3) * (2 / 3) * 30 / 59, rel=0.02)


def test_texts_hold_the_words_taken_and_shards_their_quotas(spark):
    rows, docs = docs_of(spark)
    mixed = mixing.mix(docs, carry=("text",), blocks=16, shards=4)
    quotas = {r["shard"]: r["n"] for r in mixed.select(F.explode("segments").alias("s")).groupBy("s.shard").agg(F.sum("s.n_words").alias("n")).collect()}
    parts = mixing.mixed_texts(mixed, "text", ["doc_id", "text", "source"]).collect()
    words = {}
    for r in parts:
        words[r["shard"]] = words.get(r["shard"], 0) + len(r["text"].split())
    assert words == quotas and sum(words.values()) == mixed.agg(F.sum("taken")).first()[0]
    # every part is a piece of its document as it stands, line breaks included
    of = {}
    for k, t, *_ in rows:
        of.setdefault(k, []).append(t or "")
    assert all(any(r["text"] in t for t in of[r["doc_id"]]) for r in parts)
    texts = mixing.shuffled(mixing.mixed_texts(mixed, "text", ["doc_id", "text", "source"]), ["doc_id", "text", "source"])
    assert texts.columns == ["doc_id", "text", "source"] and texts.count() == len(parts)


def test_line_breaks_survive_a_cut(spark):
    text = "\n".join(f"line {i}\tof words" for i in range(50))
    docs = spark.createDataFrame([(1, text, "a"), (2, "b " * 10, "b")], "doc_id long, text string, source string")
    parts = mixing.mixed_texts(mixing.mix(docs, carry=("text",), blocks=4), "text", ["doc_id", "text", "source"]).collect()
    cut = [r["text"] for r in parts if r["doc_id"] == 1]
    assert len(cut) >= 4 and all(t in text for t in cut)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_reruns_agree_with_several_texts_under_one_id(spark, seed):
    rows = [(7, " ".join(f"w{i}" for i in range(5 + 13 * k)), "a") for k in range(6)]
    rows += [(None, f"no id {k} " * (k + 1), "a") for k in range(6)] + [(k, "other words " * 20, "b") for k in range(9)]
    random.Random(seed).shuffle(rows)
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(seed)).collect()
    got = sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in got)
    want = sorted((r["doc_id"] or -1, r["size"], r["taken"]) for r in mixing.mix(spark.createDataFrame(sorted(rows, key=str), "doc_id long, text string, source string")).collect())
    assert got == want


def test_empty_table(spark):
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0
