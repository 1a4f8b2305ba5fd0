"""A cleaning pipeline over ``documents``: language, near-duplicates, benchmark passages, personal data, pieces.

Each stage takes (spark, docs, sf_dir), calls one operator on all that the stage before it kept, and is written as
Parquet and read again for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbwatch.llm import decontam, langid, pieces, pii, simhash
from kerbwatch.llm.common import materialise, table

WIDTH, BUDGET = 4, 4


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models accept; texts without a letter, null ones and gibberish go."""
    model = langid.fit(docs)
    return langid.keep(docs, model)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates (SimHash of four-word shingles, four bits)."""
    return simhash.one_of_each(docs, width=WIDTH, budget=BUDGET)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents that are mostly such passages go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    return pii.redact(docs)


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece numbers of every text, with the proof that they decode to it."""
    return pieces.encode(docs, keep=("lang", "source"))


STAGES = [("language", known_language), ("near_duplicates", one_of_each_group), ("decontamination", without_benchmark),
          ("personal_data", without_personal_data), ("pieces", as_pieces)]
#: The stages learn models, hash and sample; SQL cannot express them. Tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
