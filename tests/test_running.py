import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from brook import first_seen_index, global_index, indexed_counts, running_counts_batch
from brook.functions.text import TAG
from brook.operators.tokens import explode_tokens

from conftest import rows


def skewed(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # one key holds about a third of all rows; some null keys
        k = "hot" if rnd.random() < 0.34 else (None if rnd.random() < 0.05 else f"k{rnd.randrange(50)}")
        data.append((i * 3 + rnd.randrange(3), k))
    return spark.createDataFrame(data, "o long, k string")


def test_running_counts_match_window(spark):
    df = skewed(spark)
    expect = df.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)))
    for nb in (1, 3, 16):
        assert rows(running_counts_batch(df, "k", "o", n_blocks=nb)) == rows(expect)


def test_global_index_dense_and_ordered(spark):
    df = skewed(spark)
    for nb in (1, 5, 32):
        got = global_index(df, ["o"], n_blocks=nb).orderBy("o").collect()
        assert [r.idx for r in got] == list(range(len(got)))


def test_global_index_hot_first_column(spark):
    # every row shares the first order column: blocks come from the second one
    df = spark.range(500).select(F.lit(1).alias("a"), (499 - F.col("id")).alias("b"))
    got = global_index(df, ["a", "b"], n_blocks=8).orderBy("b").collect()
    assert [r.idx for r in got] == list(range(500))


def test_first_seen_index_tags(spark):
    docs = spark.createDataFrame([(1, "#b @a #b"), (2, "#c #a"), (3, None), (4, "#a #d")], "doc_id long, text string")
    toks = explode_tokens(docs, "text", TAG, keep=["doc_id"], pos="pos")
    got = rows(first_seen_index(toks, "token", ["doc_id", "pos"]), "token", "idx")
    assert got == [("#a", 3), ("#b", 0), ("#c", 2), ("#d", 4), ("@a", 1)]


def test_indexed_counts(spark):
    ev = spark.createDataFrame(
        [(1, "2024-01-01 00:00:01", "x"), (2, "2024-01-01 00:00:02", "y"), (3, "2024-01-01 00:00:06", "x")],
        "id long, ts string, tok string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = rows(indexed_counts(ev, "tok", ["id"], "ts", "5 seconds"), "token_idx", "n")
    assert got == [("x_0", 1), ("x_0", 1), ("y_1", 1)]
    # past the size bound the index is joined by a shuffle join, with the same result
    for bounds in ({"max_broadcast_rows": 0}, {"max_broadcast_bytes": 0}):
        shuffled = indexed_counts(ev, "tok", ["id"], "ts", "5 seconds", **bounds)
        assert rows(shuffled, "token_idx", "n") == got


def test_indexed_tag_counts_ranked_per_window(spark):
    from brook import indexed_tag_counts

    posts = spark.createDataFrame(
        [(1, "2024-01-01 00:00:01", "#b #a #b"), (2, "2024-01-01 00:00:02", "@c #a"), (3, "2024-01-01 00:00:07", "#a1 #b")],
        "id long, ts string, text string",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = {r.ws.second: [(e.n, e.token) for e in r.ranked] for r in indexed_tag_counts(posts, "text", "ts", ["id"]).collect()}
    assert got == {0: [(2, "#a_1"), (2, "#b_0"), (1, "@c_2")], 5: [(1, "#a_1"), (1, "#b_0")]}


def test_global_index_orders_of_any_type(spark):
    # fractional times, local times, strings and doubles: ids follow row_number over the same order
    base = spark.range(3000).select(
        F.pmod(F.xxhash64("id"), F.lit(700)).alias("x"), F.col("id").alias("b"),
    )
    kinds = {
        "fractional": F.timestamp_micros(F.col("x") * 1000 + 1_700_000_000_000_000),
        "local": F.timestamp_micros(F.col("x") * 333_333).cast("timestamp_ntz"),
        "text": F.concat(F.lit("u"), F.col("x")),
        "double": F.col("x") / 7.0,
    }
    for name, col in kinds.items():
        df = base.withColumn("a", col)
        want = df.withColumn("idx", F.row_number().over(Window.orderBy("a", "b")) - 1)
        got = global_index(df, ["a", "b"], n_blocks=16)
        assert rows(got, "b", "idx") == rows(want, "b", "idx"), name
