"""Registered queries of this package: every operator over its whole table, with production parameters."""

from __future__ import annotations

from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm.bpe import read_ranks, round_trip
from zoneflow.llm.collocations import collocations
from zoneflow.llm.common import table
from zoneflow.llm.embeddings import near_duplicate_vectors
from zoneflow.llm.html_text import extract_text
from zoneflow.llm.html_text import fit as fit_extractor
from zoneflow.llm.line_templates import line_report
from zoneflow.llm.mixing import mix_sources
from zoneflow.llm.quality import judge_quality
from zoneflow.llm.quality_classifier import score_quality
from zoneflow.llm.secrets import fit as fit_forest
from zoneflow.llm.secrets import scan_secrets
from zoneflow.llm.simhash import near_duplicates
from zoneflow.llm.token_alignment import align_tokens
from zoneflow.llm.toxicity import fit as fit_toxicity
from zoneflow.llm.toxicity import score_toxicity
from zoneflow.llm.url_filter import judge_urls

RANKS = "byte_bpe_multi_50k.tiktoken"
ALIGNED = ("byte_bpe_50k.json", "piece_bpe_32k.model")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"))
    return judged.withColumn("cleaned_sha256", F.sha2(F.coalesce("cleaned", F.lit("")), 256)).drop("cleaned")


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = read_ranks(public_tokenizers.path(RANKS))
    return round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan_secrets(docs, fit_forest(docs))
    return found.select(
        "doc_id", "nth", F.length("value").cast("long").alias("n_chars"), F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract_text(pages, fit_extractor(pages))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_report(table(spark, sf_dir, "documents"))
    return report.select(
        "doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, second = (Path(public_tokenizers.path(name)).read_bytes() for name in ALIGNED)
    return align_tokens(table(spark, sf_dir, "documents"), first, second)


QUERIES = {
    "op1_quality_rules": quality_rules,
    "op2_toxicity": toxicity,
    "op3_url_filter": url_filter,
    "op4_simhash_near_dedup": simhash_near_dedup,
    "op5_byte_bpe": byte_bpe,
    "op6_embedding_near_dedup": embedding_near_dedup,
    "op7_secret_scan": secret_scan,
    "op8_html_extraction": html_extraction,
    "op9_source_mixing": source_mixing,
    "op10_line_dedup": line_dedup,
    "op11_phrase_collocations": phrase_collocations,
    "op12_quality_classifier": quality_classifier,
    "op13_token_alignment": token_alignment,
}
