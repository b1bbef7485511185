"""Queries ``opN_<name>`` over the whole tables with production parameters, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brook.llm import (
    alignment, ann, fingerprint, htmltext, lexical, licenses, mixing, neardup, oracle, packing, quality, secrets, toxicity, warc,
)
from brook.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def q_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def q_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = toxicity.fit_model(docs, read(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def q_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"))


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return judged.select("doc_id", *[f"quality.{f}" for f in fields])


def q_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *secrets.digest(found))


def q_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *licenses.digest())


def q_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = warc.write_archives(read(spark, sf_dir, "pages"), scratch_path(spark, "warc-monolithic"))
    normal = warc.normalise(spark, whole, scratch_path(spark, "warc"))
    return warc.read_archives(spark, normal).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def q_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = htmltext.extract_text(read(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def q_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def q_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(read(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


def q_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents"))


def q_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(read(spark, sf_dir, "documents"))


def q_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.build_index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_pack_sequences": q_pack_sequences,
    "op2_toxicity": q_toxicity,
    "op3_near_duplicates": q_near_duplicates,
    "op4_quality_rules": q_quality_rules,
    "op6_secrets": q_secrets,
    "op5_html_text": q_html_text,
    "op7_warc": q_warc,
    "op8_licenses": q_licenses,
    "op9_mix_sources": q_mix_sources,
    "op10_neighbours": q_neighbours,
    "op11_token_alignment": q_token_alignment,
    "op12_fingerprints": q_fingerprints,
    "op13_ranked_search": q_ranked_search,
}

ORACLE: dict[str, str] = oracle.ORACLE
