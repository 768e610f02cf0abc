"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, exact_dedup, language, line_templates, merkle, packing, ranked_search, secret_scan, simhash, \
    site_style, substrings, token_counts, toxicity
from .tables import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.line_digests(table(spark, sf_dir, "documents"))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_digests(table(spark, sf_dir, "documents"))


def op7_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.page_texts(table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.piece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_counts(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digests(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_exact_dedup, op3_simhash, op4_toxicity, op5_line_templates, op6_substrings, op7_site_style, op8_token_counts, op9_secrets, op10_packing, op11_ranked_search, op12_language, op13_merkle_manifest)}
