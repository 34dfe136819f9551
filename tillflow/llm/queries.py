"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import alignment, decontamination, hard_negatives, html_extraction, lm_scoring, near_duplicates, quality_rules, repeats, resharding, url_filter, wavelet
from tillflow.llm.bpe_codec import encode_texts
from tillflow.llm.text import table
from tillflow.llm.token_counts import count_tokens


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leak_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.shard_documents(table(spark, sf_dir, "documents"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.held_out_scores(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract_main_text(table(spark, sf_dir, "pages"))


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(url_filter.page_captures(pages), url_filter.derived_entries(pages))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeat_report(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_file_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine_negatives(hard_negatives.relabelled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_resharding": op3_resharding,
    "op4_minhash_dedup": op4_minhash_dedup,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_html_extraction": op6_html_extraction,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_url_filter": op8_url_filter,
    "op9_quality_rules": op9_quality_rules,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_token_files": op11_token_files,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

#: DuckDB SQL over the raw tables, where SQL can express the operator.
SQL: dict[str, str] = {
    "op8_url_filter": url_filter.SQL,
    "op9_quality_rules": quality_rules.SQL,
    "op13_hard_negatives": hard_negatives.SQL,
}
