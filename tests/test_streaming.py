import os

import pytest
from pyspark.sql import functions as F

from brook import count_by, explode_tokens, first_seen_index, rank_counts, ranked_list, render_ranked, tumbling_counts
from brook.functions.text import WORD
from brook.streaming.index import FirstSeenIndexer
from brook.streaming.ranked import windowed_ranked_lists
from brook.streaming.runner import replay_splits, replay_to_table, run_to_table

from conftest import rows

SF = "/root/testdata/sf0.001"


def _events(spark, *cols):
    return spark.read.parquet(f"{SF}/events.parquet").select(*(cols or ("event_id", "ts", "event_type")))


def _closed(batch, ev, size):
    cut = ev.agg(F.max("ts")).first()[0]
    return batch.where(F.col("ws") + F.expr(f"INTERVAL {size}") <= F.lit(cut))


def test_replay_splits_are_time_ordered_ranges(spark):
    ev = _events(spark)
    seen = []
    for i, src in enumerate(replay_splits(ev, "ts", 3, "t-splits")):
        seen.append(spark.read.parquet(src).count())
    assert len(seen) == 3 and seen[-1] == ev.count() and seen == sorted(seen)


def test_batch_equals_stream_tumbling(spark):
    ev = _events(spark)
    got = replay_to_table(ev, "ts", 3, "t_tumble", lambda s: tumbling_counts(s, "ts", ["event_type"], "1 hour", delay="0 seconds"))
    assert rows(got) == rows(_closed(tumbling_counts(ev, "ts", ["event_type"], "1 hour"), ev, "1 HOUR"))


def test_running_counts_complete_and_update_modes(spark):
    ev = _events(spark, "event_id", "ts", "event_type", "user_id")
    got = replay_to_table(ev, "event_id", 3, "t_running", lambda s: count_by(s, ["event_type"]), mode="complete")
    assert rows(got) == rows(count_by(ev, ["event_type"]))
    upd = replay_to_table(ev, "event_id", 3, "t_update", lambda s: count_by(s, ["user_id"]), mode="update", keys=["user_id"])
    assert rows(upd) == rows(count_by(ev, ["user_id"]))


def test_ranked_running_table_complete_mode(spark):
    ev = _events(spark)
    build = lambda s: rank_counts(count_by(s, ["event_type"]), token="event_type")
    got = replay_to_table(ev, "event_id", 2, "t_rank_run", build, mode="complete")
    assert rows(got) == rows(count_by(ev, ["event_type"]))


def test_windowed_ranked_lists_stream_matches_batch(spark):
    ev = _events(spark)

    def build(s):
        lists = windowed_ranked_lists(s, "ts", "event_type", "1 hour", "0 seconds")
        return lists.select("ws", render_ranked("ranked").alias("r"))

    got = replay_to_table(ev, "ts", 3, "t_ranked", build)
    batch = ranked_list(tumbling_counts(ev, "ts", ["event_type"], "1 hour"), token="event_type", by=["ws"])
    closed = _closed(batch, ev, "1 HOUR").select("ws", render_ranked("ranked").alias("r"))
    assert rows(got) == rows(closed)


def _tokens(stream):
    return explode_tokens(stream, "text", WORD, keep=["doc_id"], out="w", pos="pos")


def test_first_seen_indexer_across_batches_and_restart(spark, tmp_dir):
    docs = spark.createDataFrame(
        [(1, "b a b"), (2, "c a"), (3, "d b e"), (4, "a f"), (5, "g c h"), (6, "i")], "doc_id long, text string"
    )
    dict_path, ckpt = os.path.join(tmp_dir, "dict"), os.path.join(tmp_dir, "ckpt")
    idx = FirstSeenIndexer(dict_path, token="w", order=["doc_id", "pos"], compact_every=2)
    source = None
    for source in replay_splits(docs, "doc_id", 3, "t-fsi"):
        q = idx.start(_tokens(spark.readStream.schema(docs.schema).parquet(source)), ckpt)
        q.awaitTermination()
    # ids continue across micro-batches: offsets come from the earlier dictionary partitions
    batch = first_seen_index(_tokens(docs), "w", ["doc_id", "pos"])
    assert rows(idx.dictionary(spark)) == rows(batch)
    # re-running a batch id rewrites its partition with the same ids (exactly-once)
    batch_ids = sorted(int(d.split("=")[1]) for d in os.listdir(os.path.join(dict_path, "parts")) if d.startswith("batch_id="))
    assert len(batch_ids) >= 3
    assert any(d.startswith("through=") for d in os.listdir(os.path.join(dict_path, "snapshots")))
    idx.process_batch(_tokens(docs.where("doc_id >= 5")), batch_ids[-1])
    assert rows(idx.dictionary(spark)) == rows(batch)
    # a new file after a restart: only its new tokens get new ids
    spark.createDataFrame([(7, "zz a")], "doc_id long, text string").write.mode("append").parquet(source)
    q = idx.start(_tokens(spark.readStream.schema(docs.schema).parquet(source)), ckpt)
    q.awaitTermination()
    d = dict(rows(idx.dictionary(spark)))
    assert d["zz"] == len(d) - 1 and d["a"] == dict(rows(batch))["a"]


def test_indexer_emits_indexed_occurrences(spark, tmp_dir):
    ev = spark.createDataFrame(
        [(1, "x"), (2, "y"), (3, "x"), (4, "z"), (5, "y")], "event_id long, tok string"
    ).withColumn("ts", F.timestamp_seconds(F.col("event_id")))
    occ = os.path.join(tmp_dir, "occ")
    idx = FirstSeenIndexer(os.path.join(tmp_dir, "d"), token="tok", order=["event_id"], occurrences_path=occ, carry=["event_id"])
    for source in replay_splits(ev, "event_id", 2, "t-occ"):
        q = idx.start(spark.readStream.schema(ev.schema).parquet(source), os.path.join(tmp_dir, "ck"))
        q.awaitTermination()
    got = rows(spark.read.parquet(occ).select("event_id", "token_idx"))
    assert got == [(1, "x_0"), (2, "y_1"), (3, "x_0"), (4, "z_2"), (5, "y_1")]


def test_dictionary_with_a_gap_raises(spark, tmp_dir):
    idx = FirstSeenIndexer(os.path.join(tmp_dir, "gap"), token="w", order=["doc_id", "pos"])
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    idx.process_batch(_tokens(docs), 0)
    with pytest.raises(RuntimeError, match="batch 1"):
        idx.process_batch(_tokens(docs), 2)


def test_repeated_batch_adds_nothing_downstream(spark, tmp_dir):
    occ = os.path.join(tmp_dir, "occ")
    idx = FirstSeenIndexer(os.path.join(tmp_dir, "rep"), token="w", order=["doc_id", "pos"], occurrences_path=occ, carry=["doc_id"])
    toks = _tokens(spark.createDataFrame([(1, "a b"), (2, "c a")], "doc_id long, text string"))
    schema = "doc_id long, token_idx string, batch_id int"
    out = []
    for _ in range(2):
        idx.process_batch(toks, 0)
        stream = spark.readStream.schema(schema).parquet(occ)
        out.append(run_to_table(stream, "rep", checkpoint=f"{tmp_dir}/ck", path=f"{tmp_dir}/out").count())
    assert out == [4, 4]


def test_replay_keeps_rows_without_order(spark):
    df = spark.createDataFrame([(None, "x"), (1, "y"), (7, "z")], "k long, v string")
    assert rows(replay_to_table(df, "k", 3, "t-null", lambda s: s)) == rows(df)


def test_timeout_raises(spark):
    slow = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    with pytest.raises(TimeoutError):
        run_to_table(slow, "t-slow", trigger={"processingTime": "1 second"}, timeout_s=3)
