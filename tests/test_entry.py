import duckdb
import pytest

import __spark_entry__ as entry
from brook.session import TABLES

from conftest import rows

SF = "/root/testdata/sf0.001"
FAST = [
    "read_lines", "word_count", "keyword_filter", "track_filter", "decode_json", "format_tweet", "publish_json",
    "format_line_event", "tumbling_counts", "sliding_counts", "running_counts_batch", "ranked_list_window",
    "first_seen_index", "first_seen_index_words", "first_seen_index_event_time", "indexed_tag_counts", "log_lines", "messages_roundtrip", "publish_raw", "indexed_counts", "lexicon_sentiment", "replay_lines",
    "track_filter_many", "python_model_sentiment", "track_filter_2000", "decode_variant", "model_sentiment", "model_sentiment_stream",
]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["word", "n"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    missing = set(entry.QUERIES) - set(entry.oracle_sql())
    assert missing == set()
    assert len(entry.queries()) >= 36


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    return v


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    by = lambda row: tuple((v is not None, 0 if v is None else v) for v in row)  # noqa: E731  nulls first
    got = sorted((tuple(_norm(r[c]) for c in sorted(df.columns)) for r in df.collect()), key=by)
    idx = [dcols.index(c) for c in sorted(dcols)]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=by)
    assert got == exp


def test_entry_works_without_the_optional_operators(tmp_dir):
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(root, "brook"), f"{tmp_dir}/brook", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_dir)
    code = "import __spark_entry__ as e; assert set(e.queries()) == set(e.QUERIES) and 'pipeline' not in e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_dir, env=env, check=True)
