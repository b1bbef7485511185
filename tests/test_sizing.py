import contextlib
import io

from pyspark.sql import functions as F

from brook.operators.sizing import broadcast_if_bounded, is_bounded, row_bytes


def test_row_bytes_counts_string_length(spark):
    df = spark.createDataFrame([("ab", 1), ("abcdef", 2), (None, 3)], "t string, i long")
    got = [r.b for r in df.select(row_bytes(df).alias("b")).orderBy("i").collect()]
    # row overhead 16 + string (utf-8 length + 8) + fixed 8
    assert got == [16 + 10 + 8, 16 + 14 + 8, 16 + 8 + 8]


def test_bounded_by_rows_and_bytes(spark):
    df = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("t"))
    assert is_bounded(df, max_rows=100, max_bytes=10**6)
    assert not is_bounded(df, max_rows=99, max_bytes=10**6)
    # 100 rows of ~1 KB: under the row bound, over a 50 KB byte bound
    assert not is_bounded(df, max_rows=100, max_bytes=50_000)
    assert is_bounded(df.limit(0))


def test_broadcast_only_when_bounded(spark):
    small = spark.range(10).withColumn("v", F.lit("a"))
    big = spark.range(1000).toDF("id")
    probe = spark.range(2000).toDF("id")

    def hinted(side):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            probe.join(side, "id").explain("extended")
        return "strategy=broadcast" in out.getvalue()

    assert hinted(broadcast_if_bounded(small, max_rows=100))
    assert not hinted(broadcast_if_bounded(big, max_rows=100))
