from pyspark.sql import functions as F

from brook import count_by, ranked_list, render_ranked

from conftest import rows


def counts(spark):
    return spark.createDataFrame(
        [(1, "b", 2), (1, "a", 2), (1, "c", 5), (2, "x", 1)], "w long, token string, n long"
    )


def test_ranked_list_per_group_total_order(spark):
    got = {r.w: [(e.n, e.token) for e in r.ranked] for r in ranked_list(counts(spark), by=["w"]).collect()}
    assert got == {1: [(5, "c"), (2, "a"), (2, "b")], 2: [(1, "x")]}


def test_ranked_list_topk_and_render(spark):
    got = ranked_list(counts(spark), by=["w"], k=2).select("w", render_ranked("ranked").alias("s"))
    assert rows(got) == [(1, "c:5,a:2"), (2, "x:1")]
    glob = ranked_list(counts(spark), k=3).select(render_ranked("ranked").alias("s")).collect()
    assert [r.s for r in glob] == ["c:5,a:2,b:2"]


def test_ranked_list_empty_input_gives_no_row(spark):
    empty = counts(spark).where(F.lit(False))
    assert ranked_list(empty).count() == 0
    assert ranked_list(empty, by=["w"]).count() == 0


def test_count_by_multiple_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1)], "k string, g long")
    assert rows(count_by(df, ["k", "g"])) == [(None, 1, 1), ("a", 1, 2), ("a", 2, 1)]
