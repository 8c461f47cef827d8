"""The numbered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.llm import (
    digest_index, fill_middle, filter_audit, html_text, langid, minhash, mixing, packing, quality, secret_scan, toxicity,
    vector_join, warc,
)
from sluiceway.llm import pipeline_sql as sql
from sluiceway.llm.text import read_table
from sluiceway.session import scratch_dir


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.reading_order(mixing.mixing_plan(read_table(spark, sf_dir, "documents")))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read_table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = digest_index.fresh_index(spark)
    found = index.add(read_table(spark, sf_dir, "documents"))
    index.close()
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read_table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "warc")
    return warc.read_archives(warc.write_archives(read_table(spark, sf_dir, "pages"), folder), folder)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(read_table(spark, sf_dir, "documents"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_of(read_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(spark, f"{sf_dir}/documents.parquet", read_table(spark, sf_dir, "labels"))


def op12_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_join.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.middle_digests(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_mixing": op2_mixing,
    "op3_html_text": op3_html_text,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_packing": op5_packing,
    "op6_quality": op6_quality,
    "op7_warc": op7_warc,
    "op8_secret_scan": op8_secret_scan,
    "op9_langid": op9_langid,
    "op10_toxicity": op10_toxicity,
    "op11_filter_audit": op11_filter_audit,
    "op12_vector_dedup": op12_vector_dedup,
    "op13_fill_middle": op13_fill_middle,
}

ORACLE_SQL = {
    "op1_minhash": sql.NEAR_SQL,
    "op2_mixing": sql.MIXING_SQL,
    "op4_exact_dedup": sql.EXACT_SQL,
    "op5_packing": sql.PACKING_SQL,
    "op6_quality": sql.QUALITY_SQL,
    "op7_warc": sql.WARC_SQL,
    "op11_filter_audit": filter_audit.oracle_query(),
    "op12_vector_dedup": vector_join.oracle_query(),
    "op13_fill_middle": fill_middle.oracle_query(),
}
