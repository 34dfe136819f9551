"""Corpus pipeline over ``documents``.

Each stage is a function of (spark, docs, sf_dir) and gets what the one before kept:
quality rules (rejected documents and frequent lines go), near duplicates (one
document of each group stays), repeated byte strings (cut out), benchmark leaks
(documents go), BPE codes. All but the last return the columns of ``documents``,
with n_chars brought up to date where the text changes.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillflow.llm.bpe_codec import encode_texts
from tillflow.llm.decontamination import clean_texts
from tillflow.llm.near_duplicates import one_per_group
from tillflow.llm.quality_rules import kept_texts
from tillflow.llm.repeats import without_repeats
from tillflow.llm.text import staged, table
from tillflow.runtime import ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return kept_texts(docs, chars_col="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return one_per_group(docs, k=5, percent=80)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return without_repeats(docs, chars_col="n_chars")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_texts(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return encode_texts(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontamination", decontamination),
    ("bpe_codes", encoding),
]

#: Connected groups and merges by rank can't be written in plain SQL; the tests hold
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline", name)
    return docs
