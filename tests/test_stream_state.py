"""Keyed state: first-seen ids, a pane per element; ranked pages; the message log."""

import random

import pytest
from pyspark.sql import functions as F

from brook import (
    FirstSeenState,
    attribute,
    first_seen_index,
    publish_json,
    publish_raw,
    ranked_list,
    ranked_pages,
    read_messages,
    run_to_table,
    running_counts_batch,
    running_panes,
    tumbling_counts,
    windowed_ranked_pages,
    with_rocksdb,
)

from conftest import rows


def _tokens(n=600, seed=2):
    rng = random.Random(seed)
    return [(i, rng.choice([None, f"t{int(rng.expovariate(0.02))}"])) for i in range(n)]


def _source(spark, data, schema, path, order, files=4):
    """Files of ascending order, one micro-batch each."""
    df = spark.createDataFrame(data, schema)
    step = -(-len(data) // files)
    for k in range(files):
        part = spark.createDataFrame(data[k * step : (k + 1) * step], schema)
        part.coalesce(1).write.mode("append").parquet(path)
    return df, spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _drain(query):
    query.awaitTermination()
    assert query.exception() is None


def test_first_seen_state_equals_the_batch_index(spark, tmp_dir):
    df, stream = _source(spark, _tokens(), "ord long, token string", f"{tmp_dir}/in", "ord")
    state = FirstSeenState(f"{tmp_dir}/dict")
    _drain(state.start(stream, f"{tmp_dir}/ckpt"))
    assert rows(state.dictionary(spark)) == rows(first_seen_index(df, "token", ["ord"]))
    # a restart with new input goes on from the stored state
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(["new1", "t1", "new2", "t0", "new1"])], df.schema)
    more.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    _drain(state.start(stream, f"{tmp_dir}/ckpt"))
    assert rows(state.dictionary(spark)) == rows(first_seen_index(df.union(more), "token", ["ord"]))


def test_a_batch_reads_only_the_stored_count(spark, tmp_dir):
    state = FirstSeenState(f"{tmp_dir}/dict")
    spark.range(1).select(F.lit(5_000_000).cast("long").alias("n")).write.parquet(f"{tmp_dir}/dict/counts/batch_id=6")
    batch = state.firsts(spark.createDataFrame([(3, "b"), (1, "a"), (2, "b"), (4, None)], "ord long, token string"))
    for _ in range(2):  # a repeated batch gives the same ids; no earlier part of the dictionary is there to be read
        state.process_batch(batch, 7)
        assert rows(state.dictionary(spark)) == [("a", 5_000_000), ("b", 5_000_001)]
    assert spark.read.parquet(f"{tmp_dir}/dict/counts/batch_id=7").first()["n"] == 5_000_002


def test_old_tokens_leave_the_state_unnumbered(spark, tmp_dir):
    _, stream = _source(spark, [(i, "same") for i in range(40)], "ord long, token string", f"{tmp_dir}/in", "ord")
    state = FirstSeenState(f"{tmp_dir}/dict")
    _drain(state.start(stream, f"{tmp_dir}/ckpt"))
    assert rows(state.dictionary(spark)) == [("same", 0)]
    parts = spark.read.parquet(f"{tmp_dir}/dict/parts")
    assert parts.count() == 1 and spark.read.parquet(f"{tmp_dir}/dict/counts").count() == 4


def test_panes_fire_on_every_element(spark, tmp_dir):
    data = [(i, k, f"x{i}") for i, (_, k) in enumerate(_tokens(300))]
    df, stream = _source(spark, data, "ord long, token string, other string", f"{tmp_dir}/in", "ord", files=3)
    panes = running_panes(stream, "token", ["ord"])
    got = with_rocksdb(spark, lambda: run_to_table(panes, "panes", checkpoint=f"{tmp_dir}/ckpt", path=f"{tmp_dir}/out"))
    assert rows(got) == rows(running_counts_batch(df, "token", "ord").select(*got.columns))
    more = spark.createDataFrame([(900, "t0", "y"), (901, None, "z")], df.schema)
    more.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
    got = with_rocksdb(spark, lambda: run_to_table(panes, "panes", checkpoint=f"{tmp_dir}/ckpt", path=f"{tmp_dir}/out"))
    assert rows(got) == rows(running_counts_batch(df.union(more), "token", "ord").select(*got.columns))


def test_pages_are_the_list_cut(spark):
    rng = random.Random(7)
    data = [(g, f"k{i}", rng.randint(1, 5)) for g in ("a", "b", None) for i in range({"a": 55, "b": 10}.get(g, 3))]
    counts = spark.createDataFrame(data, "g string, token string, n long")
    pages = ranked_pages(counts, by=["g"], page_size=10).collect()
    assert max(len(r.ranked) for r in pages) == 10
    for r in ranked_list(counts, by=["g"]).collect():
        mine = sorted((p for p in pages if p.g == r.g), key=lambda p: p.page)
        assert [p.page for p in mine] == list(range(-(-len(r.ranked) // 10)))
        assert [tuple(e) for p in mine for e in p.ranked] == [tuple(e) for e in r.ranked]
    whole = sorted(ranked_pages(counts, page_size=7).collect(), key=lambda p: p.page)
    assert [e.n for p in whole for e in p.ranked] == sorted((n for *_, n in data), reverse=True)
    assert ranked_pages(counts.limit(0), by=["g"]).collect() == []


def test_pages_of_closed_windows(spark, tmp_dir):
    rng = random.Random(9)
    data = [(i * 2, f"k{rng.randint(0, 30)}") for i in range(200)]
    df, stream = _source(spark, data, "s long, token string", f"{tmp_dir}/in", "s")
    timed = lambda d: d.select(F.timestamp_seconds("s").alias("ts"), "token")
    got = windowed_ranked_pages(timed(stream), "ts", "token", "pages", "60 seconds", "10 seconds", page_size=8)
    counts = tumbling_counts(timed(df), "ts", ["token"], "60 seconds")
    closed = counts.where(F.col("ws") + F.expr("interval 60 seconds") <= F.timestamp_seconds(F.lit(398 - 10)))
    assert rows(got.withColumn("ranked", F.col("ranked").cast("string"))) == rows(ranked_pages(closed, by=["ws"], page_size=8).withColumn("ranked", F.col("ranked").cast("string")))


PAYLOADS = [b"plain", b"two\nlines", b"cr\r\nlf", b"", None, bytes(range(256)), "é ".encode()]


@pytest.mark.parametrize("streaming", [False, True])
def test_any_payload_comes_back_unchanged(spark, tmp_dir, streaming):
    df = spark.createDataFrame([(i, p, None if i % 2 else f"v{i}") for i, p in enumerate(PAYLOADS)], "id long, value binary, kind string")
    df = df.withColumn("at", F.timestamp_seconds(F.col("id")))
    path = f"{tmp_dir}/log"
    publish_raw(df, fmt="parquet", path=path, headers={"id": "id", "kind": "kind"}, timestamp="at")
    log = read_messages(spark, "parquet", path, with_attributes=True, streaming=streaming)
    got = run_to_table(log, "log") if streaming else log
    got = got.select(attribute("id").cast("int").alias("id"), "value", attribute("kind").alias("kind"), attribute("none").alias("none"), F.unix_seconds("timestamp").alias("at"), F.size("headers").alias("n"))
    assert [(r.id, r.value and bytes(r.value), r.kind, r.none, r.at, r.n) for r in sorted(got.collect())] == [
        (i, p and bytes(p), None if i % 2 else f"v{i}", None, i, 1 + (i % 2 == 0)) for i, p in enumerate(PAYLOADS)
    ]


def test_json_messages_with_attributes(spark, tmp_dir):
    df = spark.createDataFrame([(5, "a\nb"), (6, None)], "event_time long, data string")
    publish_json(df, {"event_time": "event_time", "data": "data"}, fmt="parquet", path=f"{tmp_dir}/log", headers={"source": F.lit("file")})
    got = read_messages(spark, "parquet", f"{tmp_dir}/log", with_attributes=True, streaming=False)
    assert sorted(r.v for r in got.select(F.col("value").cast("string").alias("v")).collect()) == ['{"event_time":5,"data":"a\\nb"}', '{"event_time":6,"data":null}']
    assert {r.s for r in got.select(attribute("source").alias("s")).collect()} == {"file"} and got.where("timestamp is null").count() == 0
    with pytest.raises(ValueError, match="attributes"):
        publish_json(df, {"data": "data"}, fmt="text", path=f"{tmp_dir}/text", headers={"a": F.lit("b")})


def test_first_seen_state_hashes_and_orders_nulls_first(spark, tmp_dir):
    big = 2**63 - 1
    data = [(big, 2**31 - 1, "z"), (None, 5, "b"), (0, None, "c"), (0, -(2**31), "d"), (None, None, "a"), (-big - 1, 0, "e"), (0, 7, "f"), (-big - 1, None, "g"), (0, 7, None)]
    df, stream = _source(spark, data[::-1], "id long, pos int, token string", f"{tmp_dir}/in", "id", files=1)
    state = FirstSeenState(f"{tmp_dir}/dict", order=["id", "pos"])
    batch = df.where("token IS NOT NULL").groupBy("token").agg(F.min(F.struct("id", "pos")).alias("at")).orderBy("at")
    _drain(state.start(stream, f"{tmp_dir}/ckpt"))
    assert [r.token for r in state.dictionary(spark).orderBy("idx").collect()] == [r.token for r in batch.collect()]
    # occurrences are not sorted to find the first of each token
    plan = state.firsts(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    # other positions keep the struct
    wide = df.withColumn("pos", F.col("pos").cast("string"))
    assert rows(state.firsts(wide).select("token"), "token") == rows(batch.select("token"))
