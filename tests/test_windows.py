import datetime as dt

from pyspark.sql import functions as F

from brook import assign_window, sliding_counts, tumbling_counts
from brook.streaming.runner import run_to_table

from conftest import rows


def events(spark, secs, key="a"):
    base = dt.datetime(2024, 1, 1)
    data = [(i, base + dt.timedelta(seconds=s), key) for i, s in enumerate(secs)]
    return spark.createDataFrame(data, "id long, ts timestamp_ntz, k string")


def test_assign_and_tumbling(spark):
    df = events(spark, [0, 1, 4.9, 5, 12])
    ws = [r.ws.second for r in assign_window(df, "ts", "5 seconds").orderBy("id").collect()]
    assert ws == [0, 0, 0, 5, 10]
    got = rows(tumbling_counts(df, "ts", ["k"]), "ws", "n")
    assert [(w.second, n) for w, n in got] == [(0, 3), (5, 1), (10, 1)]


def test_sliding_each_row_in_twelve_windows(spark):
    df = events(spark, [0, 3, 61, 119.5])
    got = sliding_counts(df, "ts", ["k"], "60 seconds", "5 seconds")
    assert got.agg(F.sum("n")).first()[0] == 12 * 4


def test_streaming_late_rows_do_not_change_closed_windows(spark, tmp_dir):
    # batch 1 closes window [0,5); batch 2 carries a row at t=1 that is behind the watermark
    import os

    schema = "id long, ts timestamp_ntz, k string"
    first = events(spark, [0, 1, 2, 30])
    late = events(spark, [1, 50]).withColumn("id", F.col("id") + 100)
    src = os.path.join(tmp_dir, "src")
    first.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    ckpt, out = os.path.join(tmp_dir, "ckpt"), os.path.join(tmp_dir, "out")
    counts = tumbling_counts(stream, "ts", ["k"], "5 seconds", delay="10 seconds")
    run_to_table(counts, "late1", checkpoint=ckpt, path=out)
    late.coalesce(1).write.mode("append").parquet(src)
    res = run_to_table(counts, "late2", checkpoint=ckpt, path=out)
    got = [(r.ws.second, r.n) for r in res.orderBy("ws").collect()]
    # [0,5) closed with 3 rows; the late t=1 row is dropped; [30,35) closes once t=50 arrives
    assert got == [(0, 3), (30, 1)]
