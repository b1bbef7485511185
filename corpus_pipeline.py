"""Corpus pipeline: toxicity, near-duplicates, secrets, mixing, packing, each over what the stage before kept.

All stages but the last return the columns of ``documents``; texts that a stage changes get
their new ``n_chars``.  An empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm import mixing, neardup, packing, secrets, toxicity
from brook.session import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5 by a model learned from the labelled ones."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = toxicity.fit_model(docs, labels)
    return toxicity.score_documents(docs.select(*COLUMNS), model, score="toxicity").filter("toxicity < 0.5").select(*COLUMNS)


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.drop_near_duplicates(docs.select(*COLUMNS))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a mark."""
    return _with_length(secrets.redact_documents(docs.select(*COLUMNS)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row per document and pass, with the words taken, in shuffled shards."""
    carried = [c for c in COLUMNS if c not in ("doc_id", "source")]
    mixed = mixing.mix(docs, carry=tuple(carried))
    rows = mixing.mixed_texts(mixed, "text", COLUMNS)
    return _with_length(mixing.shuffled(rows, COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all rows with their sequence and offset."""
    return packing.pack_documents(docs)


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: DuckDB SQL for run()'s rows: a trained model and a signature join are among the stages, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows stored for the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
