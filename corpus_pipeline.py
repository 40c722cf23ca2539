"""Corpus pipeline: quality filter, line dedup, near-duplicate dedup, decontamination, mixing.

STAGES are functions (spark, docs, sf_dir) -> DataFrame; `run` writes what each returns as Parquet in the shared folder and
reads it back for the next. Each works on all that its predecessor kept, and decides whole documents or lines:

1. quality: documents that the classifier rejects go.
2. lines: repeated long lines stay in the largest id alone; documents whose text changes get its new length in n_chars.
3. near_duplicates: one document of each group of near copies stays, the one with the smallest id.
4. decontamination: documents in which a window of a benchmark item occurs go.
5. mixing: a row for each document with the number of times that the mix takes it.

All but the last return the columns of documents. Defined cases are those of the operators; an empty table passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rootloom.llm import decontam, linededup, mixing, neardup, quality
from rootloom.llm.common import stored

#: A classifier, near-duplicate components and a knapsack: SQL can't express them; tests compare with brute force.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    report = "report"
    while report in docs.columns:
        report += "_"
    rows = linededup.dedup_lines(docs, report=report)
    changed = F.col(report)["n_dropped"] > 0
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        rows = rows.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.drop(report)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.dedup(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


STAGES = [("quality", good_quality), ("lines", without_repeated_lines), ("near_duplicates", without_near_duplicates),
          ("decontamination", without_benchmark), ("mixing", mixed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
