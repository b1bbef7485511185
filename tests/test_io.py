import os
import time

from pyspark.sql import functions as F

from brook import (
    decode_json,
    format_line_event,
    lines_of,
    publish_json,
    publish_raw,
    read_lines,
    read_messages,
    replay_cycle,
    replay_lines,
    split_bad,
    write_lines,
)
from brook.schemas import FILE_EVENT

from conftest import rows


def test_read_lines_blank_and_no_final_newline(spark, tmp_dir):
    p = os.path.join(tmp_dir, "lines.txt")
    with open(p, "w") as f:
        f.write("first line\n\n  second  \nlast")
    got = [r.value for r in read_lines(spark, p).collect()]
    assert got == ["first line", "", "  second  ", "last"]


def test_write_lines_roundtrip(spark, tmp_dir):
    df = spark.createDataFrame([("a b",), ("",), ("c",)], "line string")
    out = os.path.join(tmp_dir, "out")
    write_lines(df, out, col="line")
    assert rows(read_lines(spark, out)) == rows(df)


def test_lines_of_splits_text(spark):
    df = spark.createDataFrame([(1, "a\nb\r\nc"), (2, None)], "id long, text string")
    assert rows(lines_of(df, "text", keep=["id"], pos="n")) == [(1, 0, "a"), (1, 1, "b"), (1, 2, "c")]


def test_publish_json_then_read_messages(spark, tmp_dir):
    df = spark.createDataFrame([(1700000000, "x y"), (1700000001, "z")], "event_time long, data string")
    out = os.path.join(tmp_dir, "topic")
    publish_json(df, {"event_time": "event_time", "data": "data"}, fmt="text", path=out)
    msgs = read_messages(spark, "text", out, streaming=False, with_attributes=True)
    assert set(msgs.columns) == {"value", "timestamp", "headers"}
    good, bad = split_bad(decode_json(msgs, "value", FILE_EVENT))
    assert bad.count() == 0
    assert rows(format_line_event(good)) == [("x y", 1700000000.0), ("z", 1700000001.0)]
    raw = os.path.join(tmp_dir, "raw")
    publish_raw(msgs, fmt="text", path=raw)
    assert rows(read_lines(spark, raw)) == rows(spark.read.text(out))


def test_streaming_messages_pass_through(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    spark.createDataFrame([('{"event_time": 5, "data": "q"}',)], "value string").write.text(src)
    stream = read_messages(spark, "text", src)
    good, _ = split_bad(decode_json(stream, "value", FILE_EVENT))
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = publish_json(format_line_event(good), {"data": "data", "t": "timestamp"}, fmt="text", path=out, checkpoint=ckpt)
    q.processAllAvailable()
    q.stop()
    assert [r.value for r in spark.read.text(out).collect()] == ['{"data":"q","t":5.0}']


def test_replay_cycle_skips_blank_and_strips(spark):
    lines = spark.createDataFrame([(0, " a "), (1, ""), (2, "b"), (3, "   ")], "n long, value string")
    got = replay_cycle(lines, "value", ["n"], start_epoch=100, rows_per_second=2).orderBy("tick").collect()
    assert [(r.tick, r.event_time, r.data) for r in got] == [(0, 100, "a"), (1, 100, "b")]


def test_replay_lines_rate_source_cycles(spark, tmp_dir):
    lines = spark.createDataFrame([(0, "one"), (1, ""), (2, " two ")], "n long, value string")
    stream = replay_lines(spark, lines, "value", ["n"], rows_per_second=5)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = stream.writeStream.format("parquet").option("checkpointLocation", ckpt).start(out)
    deadline = time.time() + 60
    while time.time() < deadline:
        q.processAllAvailable()
        if os.path.exists(out) and spark.read.parquet(out).count() >= 4:
            break
        time.sleep(1)
    q.stop()
    got = spark.read.parquet(out)
    assert set(r.data for r in got.collect()) == {"one", "two"}
    assert got.where(F.col("event_time") > 0).count() == got.count()


def test_write_lines_streaming(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    spark.createDataFrame([("x",), ("y z",)], "value string").write.text(src)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    q = write_lines(read_lines(spark, src, streaming=True), out, checkpoint=ckpt)
    q.processAllAvailable()
    q.stop()
    assert rows(spark.read.text(out)) == [("x",), ("y z",)]


def test_log_sink_writes_every_row(spark, tmp_dir, capsys):
    from brook import log_sink, preview

    df = spark.range(100).selectExpr("id", "if(id = 3, null, 'x') AS v")
    log_sink(df, f"{tmp_dir}/log")
    lines = [r.value for r in spark.read.text(f"{tmp_dir}/log").collect()]
    assert len(set(lines)) == 100 and '{"id":3,"v":null}' in lines
    df.write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/in")
    log_sink(stream, f"{tmp_dir}/slog", checkpoint=f"{tmp_dir}/ck", trigger={"availableNow": True}).awaitTermination()
    assert spark.read.text(f"{tmp_dir}/slog").count() == 100
    preview(df)
    assert "id" in capsys.readouterr().out
