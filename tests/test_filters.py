from brook import class_counts, classify_by_key, drop_blank, keyword_filter, lang_filter, track_filter, tracked_feed
from brook.operators import filters

from conftest import rows

DOCS = [
    (1, "Bitcoin is up", "en"),
    (2, "no match here", "en"),
    (3, "ORBIT", "de"),
    (4, None, "en"),
    (5, "the habit", "en"),
]


def docs(spark):
    return spark.createDataFrame(DOCS, "id long, text string, lang string")


def test_keyword_filter_case_insensitive_null_dropped(spark):
    assert rows(keyword_filter(docs(spark), "text", "bit"), "id") == [(1,), (3,), (5,)]


def test_drop_blank(spark):
    df = spark.createDataFrame([("a",), ("",), ("  \t",), (None,), (" b ",)], "value string")
    assert rows(drop_blank(df)) == [(" b ",), ("a",)]


def test_classify_by_key_presence(spark):
    df = spark.createDataFrame(
        [(1, '{"extended_tweet": {"full_text": "x"}}'), (2, '{"text": "y"}'), (3, '{"extended_tweet": null}'), (4, "bad")],
        "id long, value string",
    )
    got = rows(classify_by_key(df, "value", "extended_tweet"), "id", "is_extended")
    assert sorted(got) == [(1, True), (2, False), (3, True), (4, None)]
    counts = {r.is_extended: r.n for r in class_counts(classify_by_key(df, "value", "extended_tweet")).collect()}
    assert counts == {True: 2, False: 1, None: 1}


def test_track_and_lang(spark):
    d = docs(spark)
    assert rows(track_filter(d, "text", ["bitcoin", "habit"]), "id") == [(1,), (5,)]
    assert rows(lang_filter(d, ["de"]), "id") == [(3,)]
    assert rows(tracked_feed(d, "text", "lang", "bit, orbit", ["en"]), "id") == [(1,), (5,)]


def test_many_keywords_take_the_same_path(spark):
    d = docs(spark)
    many = ["bit"] + [f"zz{i}.*|({i}" for i in range(200)]
    assert rows(track_filter(d, "text", many), "id") == rows(keyword_filter(d, "text", "bit"), "id")


def test_any_of_many_keywords_equals_substring_search(spark):
    import random

    from brook.operators.filters import prefix_tree

    rng = random.Random(1)
    keywords = {"".join(rng.choices("abcd. +\u00e9", k=rng.randint(1, 9))) for _ in range(2000)} | {"ab", "abc", "x" * 3000, "x" * 3000 + "y", "a|b", "[q]"}
    texts = ["".join(rng.choices("abcdefgh. +\u00e9[]|q", k=rng.randint(0, 30))) for _ in range(300)] + ["", None, "x" * 2999, "z" + "X" * 3000]
    few = [k for k in keywords if len(k) > 3]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    for kws in (few, list(keywords)):
        got = sorted(r.id for r in track_filter(df, "text", kws).collect())
        assert got == [i for i, t in enumerate(texts) if t is not None and any(k in t.lower() for k in kws)]
    assert prefix_tree(["abcd", "abxy", "ab"]) == "ab"
    assert prefix_tree(["abcd", "abxy", "q"]) == "(?:ab(?:cd|xy)|q)"
