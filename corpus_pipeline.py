"""Corpus pipeline: five stages, each over the whole rows the last one kept.

Every stage but the last returns the columns of ``documents``; its output is
written as Parquet and read again by the next. No SQL states the stages (a
fitted model, a tokenizer), so tests/llm/test_pipeline.py holds each stage to
a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import bayes_join, decontaminate, line_crf, mix, token_file
from tillroll.llm.queries import tokenizer_path
from tillroll.llm.staging import read_table, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line CRF does not reject (score >= 0.3)."""
    return line_crf.keep(docs, line_crf.train(docs, read_table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by Jaccard >= 0.8 on five words."""
    return bayes_join.keep(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark."""
    return decontaminate.remove(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix.mixed(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of what is left, and their contents' digest."""
    return token_file.round_trip(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("token_output", token_output)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply STAGES to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
