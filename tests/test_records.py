from pyspark.sql import functions as F

from brook import decode_json, decode_variant, field, format_line_event, format_tweet, run_to_table, split_bad
from brook.schemas import FILE_EVENT, TWEET

from conftest import rows


def test_decode_quarantines_bad_records(spark):
    df = spark.createDataFrame(
        [(1, '{"text": "hi", "created_at": "now", "extra": {"deep": [1]}}'), (2, "not json"), (3, "{}"), (4, None), (5, '{"text": null}')],
        "id long, value string",
    )
    good, bad = split_bad(decode_json(df, "value", TWEET))
    assert rows(good.select("id", "msg.text"), "id", "text") == [(1, "hi"), (3, None), (5, None)]
    assert sorted(r.id for r in bad.collect()) == [2, 4]
    # the raw text of a bad record is kept
    assert [r._corrupt for r in bad.where("id = 2").collect()] == ["not json"]


def test_format_tweet_uses_element_time(spark):
    df = spark.createDataFrame(
        [(1, b'{"text": "a", "created_at": "Mon"}')], "id long, value binary"
    ).withColumn("timestamp", F.lit("2024-01-01 00:00:01.5").cast("timestamp_ntz"))
    good, _ = split_bad(decode_json(df, "value", TWEET))
    r = format_tweet(good, keep=["id"]).first()
    assert (r.text, r.created_at, r.timestamp) == ("a", "Mon", 1704067201.5)


def test_format_tweet_instant_timestamp(spark):
    df = spark.createDataFrame([(b'{"text": "a"}',)], "value binary").withColumn(
        "timestamp", F.timestamp_seconds(F.lit(10))
    )
    good, _ = split_bad(decode_json(df, "value", TWEET))
    r = format_tweet(good).first()
    assert r.created_at is None and r.timestamp == 10.0


def test_format_line_event(spark):
    df = spark.createDataFrame([('{"event_time": 1700000000, "data": "line one"}',)], "value string")
    good, _ = split_bad(decode_json(df, "value", FILE_EVENT))
    r = format_line_event(good).first()
    assert (r.data, r.timestamp) == ("line one", 1700000000.0)


BAD = ["", "  ", "\n\t", None, "null", "true", "7", '"text"', "[1, 2]", '{"text": "a"', '{"text": "a"} tail', '{"text": "a"}{"text": "b"}', "{'text': 1}",
       '{"text": "a"}] [', '{"text": "a"}} {', '{"text": "a"}, {"text": "b"}', '{"text": "a"}, "v": 2', '{"text": "a"},']
GOOD = ['{"text": "a"}', ' \n{"text": "a"}\t ', "{}", '{"text": null, "deep": {"x": [{"y": [1, "\u00e9"]}]}}']


def test_only_one_object_is_a_good_payload(spark):
    data = [(i, t) for i, t in enumerate(BAD + GOOD)]
    for kind in ("string", "binary"):
        df = spark.createDataFrame(data, "id long, value string").withColumn("value", F.col("value").cast(kind))
        for decoded in (decode_json(df, "value", TWEET), decode_variant(df, "value")):
            good, bad = split_bad(decoded)
            assert sorted(r.id for r in good.select("id", F.to_json("msg")).collect()) == list(range(len(BAD), len(data)))
            assert {r.id: r._corrupt for r in bad.collect()} == {i: t or "" for i, t in enumerate(BAD)}


def test_variant_fields_of_any_nesting(spark):
    deep = '{"user": {"tags": ["x", {"n": 5}], "id": 12345678901}, "ok": true, "a.b": 1.5}'
    df = decode_variant(spark.createDataFrame([(deep,), ("{}",)], "value string"))
    got = df.select(
        field("msg", "$.user.tags[1].n", "int").alias("n"), field("msg", "$.user.id", "long").alias("id"),
        field("msg", "$.ok", "boolean").alias("ok"), field("msg", '$["a.b"]', "double").alias("ab"), field("msg", "$.user.tags", "int").alias("no"),
    )
    assert [tuple(r) for r in got.collect()] == [(5, 12345678901, True, 1.5, None), (None, None, None, None, None)]


def test_decoding_on_a_stream(spark, tmp_dir):
    spark.createDataFrame([(t,) for t in BAD + GOOD], "value string").write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema("value string").parquet(f"{tmp_dir}/in")
    good, bad = split_bad(decode_variant(stream))
    assert run_to_table(bad.select("_corrupt"), "variant_bad").count() == len(BAD)
    assert run_to_table(good.select(field("msg", "$.text").alias("text")), "variant_good").count() == len(GOOD)
