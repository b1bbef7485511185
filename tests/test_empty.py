"""Empty input flows through every operator and gives empty (or neutral) results."""

from pyspark.sql import functions as F

from brook import (
    TAG,
    WORD,
    count_by,
    explode_tokens,
    first_seen_index,
    indexed_counts,
    lexicon_sentiment,
    rank_counts,
    replay_cycle,
    running_counts_batch,
    sliding_counts,
    tumbling_counts,
)


def test_empty_inputs(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    ev = spark.createDataFrame([], "event_id long, ts timestamp_ntz, k string")
    assert rank_counts(count_by(explode_tokens(docs, "text", WORD), ["token"])).count() == 0
    assert first_seen_index(explode_tokens(docs, "text", TAG, keep=["doc_id"], pos="pos"), "token", ["doc_id", "pos"]).count() == 0
    assert tumbling_counts(ev, "ts", ["k"]).count() == 0
    assert sliding_counts(ev, "ts", ["k"]).count() == 0
    assert running_counts_batch(ev, "k", "event_id").count() == 0
    assert indexed_counts(ev, "k", ["event_id"], "ts").count() == 0
    lex = spark.createDataFrame([("good", "positive")], "w string, cls string")
    assert lexicon_sentiment(docs, "doc_id", "text", lex).count() == 0
    lines = spark.createDataFrame([], "n long, value string")
    assert replay_cycle(lines, "value", ["n"]).count() == 0


def test_all_blank_lines_replay_nothing(spark):
    lines = spark.createDataFrame([(0, ""), (1, "  ")], "n long, value string")
    assert replay_cycle(lines, "value", ["n"]).where(F.lit(True)).count() == 0
