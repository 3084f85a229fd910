"""Corpus pipeline: documents through five of the operators, each stage stored as Parquet.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchlake.llm import decontaminate, lang_id, pieces, pii, simhash
from pitchlake.llm.common import prepare, stored, table
from pitchlake.llm.queries import tokenizer


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model is fitted on the stage's own documents."""
    prepare(spark)
    return lang_id.accepted(docs, lang_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of linked fingerprints."""
    prepare(spark)
    return simhash.representatives(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in the text replaced by the names of its kinds."""
    prepare(spark)
    return pii.masked(docs, pii.train(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (with begin and end) and the text they decode to."""
    prepare(spark)
    return pieces.encode(docs, tokenizer())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: Learned models, components and tokenizers are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
