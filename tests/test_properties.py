"""Property tests: results do not depend on how the work is partitioned."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from brook import count_by, explode_tokens, global_index, running_counts_batch, sliding_counts
from brook.operators.windows import _windowed_counts

from conftest import rows

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.sampled_from(["hot", "hot", "hot", "a", "b", "c"]))


@SETTINGS
@given(st.lists(keys, min_size=0, max_size=60), st.integers(1, 12))
def test_running_counts_independent_of_blocks(spark, ks, nb):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(ks)], "o long, k string")
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(running_counts_batch(df, "k", "o", n_blocks=nb)) == rows(df.withColumn("n", F.count(F.lit(1)).over(w)))


@SETTINGS
@given(st.lists(st.integers(-50, 50), min_size=0, max_size=60, unique=True), st.integers(1, 12))
def test_global_index_is_a_permutation_in_order(spark, xs, nb):
    df = spark.createDataFrame([(x,) for x in xs], "x long")
    got = [(r.x, r.idx) for r in global_index(df, ["x"], n_blocks=nb).collect()]
    assert sorted(got) == list(zip(sorted(xs), range(len(xs))))


@SETTINGS
@given(st.lists(st.text(alphabet="ab' #@x1", max_size=12), min_size=0, max_size=20))
def test_word_counts_sum_to_token_count(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    toks = explode_tokens(df, "text")
    total = count_by(toks, ["token"]).agg(F.sum("n")).first()[0] or 0
    assert total == toks.count()


@SETTINGS
@given(st.lists(st.integers(0, 400), min_size=1, max_size=40))
def test_sliding_preaggregation_equals_plain_sliding_window(spark, secs):
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(seconds=s), "k") for s in secs], "ts timestamp_ntz, k string")
    fast = sliding_counts(df, "ts", ["k"], "60 seconds", "5 seconds", preaggregate=True)
    plain = _windowed_counts(df, "ts", ["k"], "60 seconds", "5 seconds", None, "ws", None, "n")
    assert rows(fast) == rows(plain)
    assert fast.agg(F.sum("n")).first()[0] == 12 * len(secs)
