"""The corpus pipeline: rules, language, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  Between
stages the documents are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import bin_packing, language_mix, personal_data, quality_rules, shingle_sets
from vellum.llm.common import materialize, table


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents within the adaptive thresholds of their language and source stay."""
    return quality_rules.keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identified main language go."""
    return language_mix.keep_identified(docs, language_mix.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that a five-word similarity of 0.8 or more connects stays."""
    return shingle_sets.deduplicate(docs)


def personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; every document stays."""
    return personal_data.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' bytes in sequences of the permitted lengths."""
    return bin_packing.pack(docs)


STAGES = [("quality rules", rules), ("language id", language), ("near-duplicates", near_duplicates), ("personal data", personal), ("packing", packing)]

#: Learned models and iterative stages are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{k}")
    return docs
