import math
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F

from brook import batches_to_table, lexicon_sentiment, model_sentiment, naive_bayes_sentiment, score_with_model, train_naive_bayes, train_sentiment

from conftest import rows


def test_lexicon_shares(spark):
    docs = spark.createDataFrame(
        [(1, "Good good bad day"), (2, ""), (3, None), (4, "nothing here")], "doc_id long, text string"
    )
    lex = spark.createDataFrame([("good", "positive"), ("bad", "negative"), ("bad", "negative")], "w string, cls string")
    got = {r.doc_id: r for r in lexicon_sentiment(docs, "doc_id", "text", lex).collect()}
    assert (got[1].n_tokens, got[1].pos_hits, got[1].neg_hits) == (4, 2, 1)
    assert (got[1].positive, got[1].neutral, got[1].negative) == (0.5, 0.25, 0.25)
    for i in (2, 3):
        assert (got[i].n_tokens, got[i].positive, got[i].neutral, got[i].negative) == (0, 0.0, 1.0, 0.0)
    assert got[4].neutral == 1.0
    # past the size bound the lexicon is joined by a shuffle join, with the same scores
    shuffled = lexicon_sentiment(docs, "doc_id", "text", lex, max_literal_words=0)
    assert rows(shuffled) == rows(lexicon_sentiment(docs, "doc_id", "text", lex))


def test_model_scores_are_probabilities(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = train_sentiment(docs, labels, num_features=1 << 12)
    scored = model_sentiment(docs, model).collect()
    assert len(scored) == docs.count()
    for r in scored[:50]:
        assert abs(r.positive + r.neutral + r.negative - 1.0) < 1e-6


def test_score_with_python_model(spark):
    # defined inside the test so the closures ship to Python workers by value
    def load():
        return {"good": 1, "bad": -1}

    def score(model, texts):
        vals = [sum(model.get(w, 0) for w in (t or "").lower().split()) for t in texts]
        return pd.DataFrame(
            {
                "positive": [1.0 if v > 0 else 0.0 for v in vals],
                "neutral": [1.0 if v == 0 else 0.0 for v in vals],
                "negative": [1.0 if v < 0 else 0.0 for v in vals],
            }
        )

    docs = spark.createDataFrame([(1, "good"), (2, "bad bad"), (3, None)], "doc_id long, text string")
    got = rows(score_with_model(docs, "text", load, score, keep=["doc_id"], cache_key="toy"))
    assert got == [(1, 1.0, 0.0, 0.0), (2, 0.0, 0.0, 1.0), (3, 0.0, 1.0, 0.0)]


def test_records_keep_their_text_and_equal_ids(spark):
    docs = spark.createDataFrame([(1, "good"), (1, "bad day")], "doc_id long, text string")
    lex = spark.createDataFrame([("good", "positive"), ("bad", "negative")], "w string, cls string")
    for bound in (10, 0):
        got = lexicon_sentiment(docs, "doc_id", "text", lex, keep=["text"], max_literal_words=bound)
        assert rows(got, "doc_id", "text", "n_tokens") == [(1, "bad day", 2), (1, "good", 1)]

    def score(model, texts):
        return pd.DataFrame({"positive": [1.0] * len(texts), "neutral": [0.0] * len(texts), "negative": [0.0] * len(texts)})

    got = score_with_model(docs, "text", dict, score, cache_key="one", keep=["doc_id", "text"])
    assert rows(got, "doc_id", "text") == [(1, "bad day"), (1, "good")]


def test_model_loads_once_per_worker(spark, tmp_dir):
    def load():
        import os
        import uuid

        open(f"{tmp_dir}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return None

    def score(model, texts):
        return pd.DataFrame({"positive": [1.0] * len(texts), "neutral": [0.0] * len(texts), "negative": [0.0] * len(texts)})

    docs = spark.range(64).selectExpr("id AS doc_id", "'x' AS text").repartition(32)
    assert score_with_model(docs, "text", load, score, cache_key=tmp_dir, keep=["doc_id"]).count() == 64
    import os

    loads = [f.split("-")[0] for f in os.listdir(tmp_dir)]
    assert loads and len(loads) == len(set(loads))


TRAIN = [(1, "good good day", 0), (2, "bad day", 2), (3, "a plain day", 1), (4, "Good", 0), (5, None, 1), (6, "bad bad bad", 2)]


def _posterior(text, train):
    """Naive Bayes by a plain loop."""
    words = {c: Counter(w for _, t, k in train if k == c and t for w in t.lower().split()) for c in range(3)}
    vocabulary = set().union(*words.values())
    docs = Counter(k for _, _, k in train)
    score = [
        math.log(docs[c] / len(train)) + sum(math.log((words[c][w] + 1) / (sum(words[c].values()) + len(vocabulary))) for w in text.lower().split() if w in vocabulary)
        for c in range(3)
    ]
    parts = [math.exp(s - max(score)) for s in score]
    return [p / sum(parts) for p in parts]


def _model(spark, train=TRAIN):
    docs = spark.createDataFrame([t[:2] for t in train], "doc_id long, text string")
    return train_naive_bayes(docs, spark.createDataFrame([(t[0], float(t[2])) for t in train], "doc_id long, label double"))


def test_naive_bayes_equals_a_plain_loop(spark):
    texts = ["good", "bad day", "nothing known", "", None, "Day day good plain bad " * 300, "good"]
    df = spark.createDataFrame([(i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = naive_bayes_sentiment(df, _model(spark), keep=["doc_id", "text"]).collect()
    assert len(got) == len(texts)
    for r in got:
        want = _posterior(r.text or "", TRAIN)
        assert all(abs(a - b) < 2e-6 for a, b in zip((r.positive, r.neutral, r.negative), want, strict=True))


def test_naive_bayes_with_an_empty_class_and_without_training(spark):
    df = spark.createDataFrame([(1, "good"), (2, "day")], "doc_id long, text string")
    two = naive_bayes_sentiment(df, _model(spark, [t for t in TRAIN if t[2] != 1])).collect()
    assert all(r.neutral == 0.0 and abs(r.positive + r.negative - 1) < 2e-6 for r in two)
    none = naive_bayes_sentiment(df, _model(spark, [])).collect()
    assert len(none) == 2 and all(r.positive is None for r in none)


def test_naive_bayes_on_a_stream_equals_the_batch(spark, tmp_dir):
    df = spark.createDataFrame([(i, ("good day", "bad plain", None)[i % 3]) for i in range(30)], "doc_id long, text string")
    model = _model(spark)
    df.repartition(5).write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_dir}/in")
    batch = naive_bayes_sentiment(df, model)
    assert rows(batches_to_table(stream, "nb", lambda b: naive_bayes_sentiment(b, model), batch.schema)) == rows(batch)


def _zipf_records(spark):
    import random

    rng = random.Random(7)
    texts = [[f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randrange(40))] for _ in range(200)] + [["w1"] * 50, [], None]
    return texts, spark.createDataFrame(list(enumerate(texts)), "_id long, _tok array<string>")


def test_token_sums_broadcast_the_common_tokens_and_shuffle_the_rest(spark, monkeypatch):
    from brook.operators.lookup import token_sums

    texts, records = _zipf_records(spark)
    known = {f"w{i}": (i - 400, None if i % 5 == 0 else i) for i in range(900) if i % 7}  # w0, w7, .. are unknown
    table = spark.createDataFrame([(w, a, b) for w, (a, b) in known.items()], "token string, a long, b long")
    want = []
    for i, t in enumerate(texts):
        found = [known[w] for w in t or [] if w in known]
        if found:
            some = [b for _, b in found if b is not None]
            want.append((i, sum(a for a, _ in found), sum(some) if some else None))
    for broadcast, most in ((None, 0), (True, 0), (False, 0), (False, 8), (False, 10_000)):
        assert rows(token_sums(records, table, ["a", "b"], max_common=most, broadcast_table=broadcast)) == sorted(want)
    # the common tokens, as many as the bound allows, meet a broadcast: what is shuffled to the table is the rest
    counts = Counter(w for t in texts for w in t or [])
    from brook.operators.lookup import common_tokens

    table_of_counts = spark.createDataFrame(list(counts.items()), "token string, n long")
    common = {r.token for r in common_tokens(table_of_counts, "token", 8).collect()}
    assert 0 < len(common) <= 8 and min(counts[w] for w in common) > max(n for w, n in counts.items() if w not in common)
    from brook.operators import lookup
    from brook.session import materialize

    stored = {}
    monkeypatch.setattr(lookup, "materialize", lambda df, name: stored.setdefault(name, materialize(df, name)))
    token_sums(records, table, ["a", "b"], max_common=8, broadcast_table=False)
    looked_up = stored["looked-up"].where("token IS NOT NULL")
    assert looked_up.count() and not looked_up.where(F.col("token").isin(*common)).count()


def test_a_large_model_shuffles_no_common_token(spark, monkeypatch):
    from brook.operators import lookup

    monkeypatch.setattr(lookup, "is_bounded", lambda table: False)
    texts = ["good bad day " * 40, "plain", None, "unknown", "Day"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = naive_bayes_sentiment(df, _model(spark))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "looked-up" in "".join(got.inputFiles()) and "explode" not in plan  # all five words are common: no occurrence is joined here
    for r in got.collect():
        assert all(abs(a - b) < 2e-6 for a, b in zip((r.positive, r.neutral, r.negative), _posterior(texts[r.doc_id] or "", TRAIN), strict=True))


def test_a_model_scores_bounded_stretches_of_text(spark):
    from brook.operators.sentiment import SCORE_CHARS, text_slices

    assert list(text_slices(["ab", None, "cd", "efghijk", "", "l"], 4)) == [(0, 2), (2, 3), (3, 4), (4, 6)]
    assert list(text_slices([], 4)) == []

    def score(model, texts):
        n = float(sum(len(t or "") for t in texts))
        return pd.DataFrame({"positive": [n] * len(texts), "neutral": [0.0] * len(texts), "negative": [0.0] * len(texts)})

    docs = spark.range(0, 40, 1, 1).selectExpr("id AS doc_id", "if(id = 7, NULL, repeat('x', 100000)) AS text")
    got = rows(score_with_model(docs, "text", dict, score, cache_key="bounded", keep=["doc_id"]))
    assert [r[0] for r in got] == list(range(40)) and 100_000 <= max(r[1] for r in got) <= SCORE_CHARS
