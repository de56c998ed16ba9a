"""From raw documents to training sequences: the stages, in order, and the whole run.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir), reads what the one before it kept
and returns a table. All but the last return the columns of ``docs``. Between stages the table is written to
the folder in ``spark.checkpoint.dir`` and read again. Stages handle null and repeated values as their operators
state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm import jaccard, langid, line_dedup, mixing, packing
from gaugeflow.session import stage, tune


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told."""
    tune(spark)
    return langid.keep_identified(docs)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sites share."""
    tune(spark)
    return line_dedup.dedup_lines(docs).select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    tune(spark)
    return jaccard.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    tune(spark)
    return mixing.apply_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences."""
    tune(spark)
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("language", identified),
    ("lines", without_boilerplate),
    ("near_copies", without_copies),
    ("mix", mixed),
    ("pack", packed),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
