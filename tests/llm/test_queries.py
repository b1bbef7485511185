"""The registered queries against their SQL, and the pipeline's stages, on the smallest tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brook.llm import neardup, oracle, queries, secrets, toxicity

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck.execute(oracle.ORACLE[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in names) for r in df.collect())
    assert got == sorted(tuple(map(str, r)) for r in cur.fetchall())


def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}


def test_secrets_and_toxicity_contracts(spark):
    found = queries.q_secrets(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(found) == len(texts)
    for r in found:
        want = secrets.scan(texts[r["doc_id"]])
        assert r["spans"] == ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r["n_assign"] + r["n_access"] + r["n_hex"] == sum(k in secrets.KINDS[:3] for k, _, _ in want)
    scored = queries.q_toxicity(spark, SF).collect()
    assert len(scored) == len(texts) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored)


def test_pipeline_stages(spark):
    """Each stage against its own definition, over what the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash"))
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["toxicity"](spark, docs, SF).cache()
    assert kept.columns == COLUMNS
    model = toxicity.fit_model(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = toxicity.WordScores(model)
    want = {r["doc_id"] for r in docs.collect() if model.probability(scores.score(r["text"])) < 0.5}
    assert {r["doc_id"] for r in kept.collect()} == want

    unique = stages["near_duplicates"](spark, kept, SF).cache()
    groups = {r["component_id"] for r in neardup.near_duplicates(kept).collect()}
    assert sorted(r["doc_id"] for r in unique.collect()) == sorted(groups)

    redacted = stages["secrets"](spark, unique, SF).cache()
    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    for r in redacted.collect():
        assert r["text"] == secrets.redact(before[r["doc_id"]], secrets.scan(before[r["doc_id"]])) and r["n_chars"] == len(r["text"])

    mixed = stages["mixing"](spark, redacted, SF).cache()
    assert mixed.columns == COLUMNS
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert words(mixed.collect()) == pytest.approx(1.5 * words(redacted.collect()), rel=0.01)

    packed = stages["packing"](spark, mixed, SF).cache()
    filled = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end")).collect()
    assert all(r["n"] == r["end"] <= 1024 for r in filled)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_pipeline_of_nothing(spark):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0
