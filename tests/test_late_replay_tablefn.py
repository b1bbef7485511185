"""Late rows set aside, the replay as a stream, table functions, a joined lexicon on a stream."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brook import (
    WORD,
    apply_table_function,
    batches_to_table,
    lexicon_sentiment,
    lines_of,
    mark_late,
    replay_ticks,
    run_to_table,
    staged_ticks,
)
from brook.functions.text import tokens
from brook.operators.tablefn import WordSpans
from brook.session import materialize
from brook.sources.replay import indexed_lines

from conftest import rows

T0 = dt.datetime(2024, 1, 1)


def _at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_late_rows_are_marked_by_the_watermark_of_their_batch(spark, tmp_dir, kind):
    big = 2**60 + 1  # no double holds it
    parts = [
        [(1, big, 0.0), (2, None, 100.0), (3, 3, 40.0)],  # nothing is late in the first batch
        [(4, big, 84.0), (5, None, 85.0), (6, 6, 90.0), (7, 7, None), (5, None, 85.0)],  # watermark 90: windows ending at 90 are closed
        [(8, 8, 300.0), (9, None, 92.0)],
        [(10, big, 92.0), (11, 11, 290.0)],  # watermark 290
    ]
    schema = f"id long, n long, ts {kind}"
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        result = None
        for part in parts:
            df = spark.createDataFrame([(i, n, _at(s)) for i, n, s in part], "id long, n long, ts timestamp_ntz")
            df.select("id", "n", F.col("ts").cast(kind)).write.mode("append").parquet(f"{tmp_dir}/in")
            stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/in")
            marked = mark_late(stream, "ts", "10 seconds", "5 seconds", buckets=3)
            assert marked.schema["watermark"].dataType.simpleString() == kind
            result = run_to_table(marked, "late", checkpoint=f"{tmp_dir}/ckpt", path=f"{tmp_dir}/out", no_data_batches=False)
        assert rows(result, "id", "n") == rows(spark.createDataFrame([(i, n) for p in parts for i, n, _ in p], "id long, n long"))
        assert rows(result.where("is_late"), "id") == [(4,), (5,), (5,), (10,)]
        of = dict(rows(result.select("id", F.date_format("watermark", "HH:mm:ss"))))
        assert of[1] is None and of[4] == "00:01:30" and of[8] == "00:01:30" and of[11] == "00:04:50"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_replay_ticks_cycle_over_the_lines(spark, tmp_dir):
    docs = spark.createDataFrame([(1, " a \n\nb"), (2, "\t"), (3, "c")], "doc_id long, text string")
    idx = indexed_lines(lines_of(docs, "text", keep=["doc_id"], out="line", pos="k"), "line", ["doc_id", "k"])
    for _ in range(3):  # three micro-batches of four ticks, each after a restart
        ticks = replay_ticks(staged_ticks(spark, 4, start_epoch=100, advance_ms=5000), idx, 3)
        got = run_to_table(ticks, "ticks", checkpoint=f"{tmp_dir}/ckpt", path=f"{tmp_dir}/out")
    assert rows(got) == [(t, 100 + 5 * (t // 4), "abc"[t % 3]) for t in range(12)]
    with pytest.raises(ValueError):
        replay_ticks(staged_ticks(spark, 4), idx, 0)


def test_word_spans(spark):
    texts = [(1, "It's  é a\U0001f600b"), (2, None), (3, ""), (4, "42"), (1, "It's  é a\U0001f600b"), (5, "x " * 50_000)]
    df = spark.createDataFrame(texts, "pos_of long, text string")
    got = apply_table_function(df, WordSpans, WordSpans.returns, ["text"], keep=["pos_of"])
    assert got.columns == ["pos_of", "pos", "word", "start", "stop"]
    one = [(1, 0, "It's", 0, 4), (1, 1, "a", 8, 9), (1, 2, "b", 10, 11)]
    assert rows(got.where("pos_of < 5")) == sorted(one * 2)
    assert got.where("pos_of = 5").count() == 50_000
    assert rows(got.select("pos_of", "pos", "word")) == rows(df.select("pos_of", F.posexplode(tokens(F.col("text"), WORD))))
    assert apply_table_function(df.limit(0), WordSpans, WordSpans.returns, ["text"]).count() == 0


def test_table_function_loads_its_model_once_per_worker(spark):
    loads = []

    class Loads:
        def __init__(self):
            from brook.operators.sentiment import worker_model

            self.model = worker_model("tests.loads", lambda: loads.append(1) or {"a": 2})

        def eval(self, word):
            for _ in range(self.model.get(word, 0)):
                yield (len(loads),)

    df = spark.range(200).select(F.lit("a").alias("w")).repartition(1)
    got = apply_table_function(df, Loads, "loads int", ["w"])
    assert got.distinct().collect()[0]["loads"] <= 1 and got.count() == 400


def test_a_joined_lexicon_on_a_stream(spark, tmp_dir):
    data = [(1, "good good bad x"), (1, "good"), (2, None), (3, "")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    df.write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/in")
    lexicon = spark.createDataFrame([("good", "positive"), ("bad", "negative"), ("good", "positive")], "w string, cls string")
    with pytest.raises(ValueError):
        lexicon_sentiment(stream, "doc_id", "text", lexicon, max_literal_words=1)
    one = lexicon_sentiment(df, "doc_id", "text", lexicon)
    got = batches_to_table(
        stream, "lexicon", lambda b: lexicon_sentiment(b, "doc_id", "text", lexicon, max_literal_words=0), one.schema, f"{tmp_dir}/ckpt", f"{tmp_dir}/out"
    )
    assert rows(got) == rows(one)


def test_a_large_joined_lexicon_shuffles_no_common_token(spark, monkeypatch):
    from brook.operators import lookup

    monkeypatch.setattr(lookup, "is_bounded", lambda table: False)
    data = [(1, "good good bad x"), (1, "good"), (2, None), (3, ""), (4, "Plain X")]
    df = spark.createDataFrame(data, "doc_id long, text string")
    words = [("good", "positive"), ("bad", "negative"), ("good", "neutral"), ("x", "neutral"), (None, "positive")]
    lexicon = spark.createDataFrame(words, "w string, cls string")
    for most in (0, 200_000):
        monkeypatch.setattr(lookup, "common_tokens", lambda counts, token, _, f=lookup.common_tokens, most=most: f(counts, token, most))
        got = lexicon_sentiment(df, "doc_id", "text", lexicon, max_literal_words=0)
        assert "looked-up" in "".join(got.inputFiles())
        assert rows(got) == rows(lexicon_sentiment(df, "doc_id", "text", lexicon))


def test_a_batch_of_ticks_joins_only_its_lines(spark):
    from brook.sources.replay import replay_batch

    docs = spark.range(50).selectExpr("id AS doc_id", "concat(' l', id, '\n\n') AS text")
    idx = materialize(indexed_lines(lines_of(docs, "text", keep=["doc_id"], out="line", pos="k"), "line", ["doc_id", "k"]), "lines")
    for first, last, joined in ((0, 12, 13), (45, 57, 13), (99, 100, 2), (10, 80, 50)):
        ticks = spark.range(first, last + 1).selectExpr("timestamp_seconds(7) AS timestamp", "id AS value")
        got = replay_batch(ticks, idx, 50)
        assert rows(got) == [(t, 7, f"l{t % 50}") for t in range(first, last + 1)]
        read = [p for p in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "line_idx" in p and "Filter" in p]
        assert joined == 50 or any(f">= {first % 50}" in p and f"<= {last % 50}" in p for p in read)
    assert replay_batch(ticks.limit(0), idx, 50).count() == 0


def test_numbering_writes_and_shuffles_the_rows_once(spark, monkeypatch):
    from brook.operators import running

    stored = []
    monkeypatch.setattr(running, "materialize", lambda df, name: stored.append(name) or materialize(df, name))
    docs = spark.createDataFrame([(3, "c"), (1, " a \nb"), (2, None), (1, "z")], "doc_id long, text string")
    got = indexed_lines(lines_of(docs, "text", keep=["doc_id"], out="line", pos="k"), "line", ["doc_id", "k"])
    assert stored == ["blocks"] and "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    found = dict(rows(got))
    assert sorted(found) == [0, 1, 2, 3] and {found[0], found[1]} == {"a", "z"} and (found[2], found[3]) == ("b", "c")
