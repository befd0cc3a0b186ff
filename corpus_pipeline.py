"""Corpus pipeline over the ``documents`` table: quality filter, near-duplicate
removal, substring removal, benchmark decontamination and tokenisation.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which is written as Parquet and reread as the next
stage's docs. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import byte_bpe, decontaminate, jaccard, quality, substrings
from tillroll.llm.storage import written


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the factorisation machine, fitted on the labelled rows, scores 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, labels, "quality", ~(quality.remainder("doc_id", 3) == 1))
    return quality.keep_good(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents linked by a Jaccard similarity of 0.75 of five-word shingles."""
    return jaccard.keep_one(docs)


def repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of sentences that an earlier place has."""
    return substrings.remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with the ids of their texts in column ``ids``."""
    return byte_bpe.encode(docs)


STAGES = [("quality", quality_filter), ("near_duplicates", near_duplicates), ("substrings", repeated_substrings),
          ("decontamination", decontamination), ("tokens", tokens)]

#: Model fitting, local alignment and byte-pair merges cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; every stage but the last is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
