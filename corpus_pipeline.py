"""A training corpus from ``documents``: language ID, exact dedup, near dedup, pseudonyms, packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from curbline.llm import exact, language, packing, pseudonyms, resemblance
from curbline.llm.common import table, written
from curbline.llm.queries import KEY


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a recognised language."""
    return language.accepted(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one of equal texts."""
    return exact.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word similarity of 0.8 or more."""
    return resemblance.keep_one(docs, words=5, similarity=0.8)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal values in the texts."""
    return pseudonyms.pseudonymise(docs, KEY)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the tokens of all documents into sequences; one row per piece."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pseudonymise", pseudonymise),
    ("pack", pack),
]

# The network, the fingerprints and the tokenizer have no SQL form; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
