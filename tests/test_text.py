from pyspark.sql import functions as F

from brook import TAG, WORD, count_by, explode_tokens, rank_counts
from brook.functions.text import strip

from conftest import rows

LINES = [
    (0, "The cat and the dog. What's G'day GNU' it's"),
    (1, "Café über naïve"),
    (2, None),
    (3, ""),
    (4, "##a #a1 @b_c x@y #"),
    (5, "the the The"),
]


def frame(spark):
    return spark.createDataFrame(LINES, "id long, text string")


def test_words_case_and_apostrophes(spark):
    got = rows(explode_tokens(frame(spark), "text", WORD, keep=["id"]), "id", "token")
    assert (0, "The") in got and (0, "the") in got
    assert (0, "What's") in got and (0, "G'day") in got and (0, "GNU'") in got and (0, "it's") in got
    # accented letters split words (ASCII-only tokens)
    assert [t for i, t in got if i == 1] == sorted(["Caf", "ber", "na", "ve"])
    # null and empty text yield no tokens
    assert not [r for r in got if r[0] in (2, 3)]


def test_tags(spark):
    got = [t for i, t in rows(explode_tokens(frame(spark), "text", TAG, keep=["id"]), "id", "token")]
    assert sorted(got) == sorted(["##a", "#a", "@b", "@y"])


def test_positions_keep_order(spark):
    df = explode_tokens(frame(spark), "text", WORD, keep=["id"], pos="pos").where("id = 5")
    assert [(r.pos, r.token) for r in df.orderBy("pos").collect()] == [(0, "the"), (1, "the"), (2, "The")]


def test_word_count_sum_equals_tokens(spark):
    toks = explode_tokens(frame(spark), "text", WORD)
    counts = count_by(toks, ["token"])
    assert counts.agg(F.sum("n")).first()[0] == toks.count()
    ranked = rank_counts(counts).collect()
    assert (ranked[0].token, ranked[0].n) == ("the", 3)
    # ties: count desc then token asc
    ns = [(-r.n, r.token) for r in ranked]
    assert ns == sorted(ns)


def test_strip(spark):
    df = spark.createDataFrame([("  a b \t",), ("\tx",), ("",)], "v string")
    assert [r[0] for r in df.select(strip("v")).collect()] == ["a b", "x", ""]
