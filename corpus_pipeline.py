"""Documents to a training mix: five operators, each working on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palmleaf.llm import decontam, gbdt_quality, line_dedup, mixing, trie_join
from palmleaf.llm.common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return gbdt_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's boilerplate lines go; all documents stay."""
    return line_dedup.dedup_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return trie_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its error budget go."""
    return decontam.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, numbered by copy_no."""
    return mixing.mix(docs)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mixture", mixture)]

#: The classifier, the trie join and edit matching have no SQL form; tests/llm holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir, each result stored before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
