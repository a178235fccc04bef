"""The corpus pipeline: from raw documents to tokens of clean, distinct text.

Each stage takes what its predecessor kept, with the columns of ``documents``;
the last returns token ids and digests. Null texts and texts without a letter
go in the first stage; every stage takes empty tables. A document is named by
its id; repeated rows are copies of one document and leave one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import bpe, decontaminate, language, nearcopies, pii
from pulsegrid.llm.common import stored, table
from pulsegrid.llm.queries import tokenizer_path


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learnt language."""
    return language.accepted(docs, language.learn(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: those with a Jaccard similarity of five-word shingles of 0.8 or more."""
    return nearcopies.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark, re-parameterised or not."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind."""
    return pii.redacted(docs, pii.learn(docs))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of what they decode to."""
    return bpe.digests(docs, tokenizer_path())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("personal_data", redact_personal_data),
    ("tokens", tokenize),
]

#: No stage but the third can be said in SQL; tests/llm/test_pipeline.py has a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
