"""The corpus pipeline: language ID, near copies, repeated passages, benchmark passages, mixture."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlight.llm.contamination import contamination
from barlight.llm.jaccard import first_of_each_group
from barlight.llm.language import fold_remainder, identify, train
from barlight.llm.mixing import mix_sources
from barlight.llm.passages import remove_passages
from barlight.llm.store import kept

#: Columns that a stage hands on.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, with it as their lang: null texts and texts without a letter go.

    The label that a document came with, if any, is replaced by what its text is. Where no label is left to
    learn from, no language can be told and all documents go.
    """
    model = train(docs.where(fold_remainder(F.col("doc_id")) != 0))
    told = identify(docs, model).where("lang_pred <> 'und'")
    return told.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id."""
    return first_of_each_group(docs).select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur again. A text that loses nothing stays as it is."""
    cut = remove_passages(docs)
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't hold a benchmark item. Null texts hold none; a benchmark without rows takes none away."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items).where("not contaminated").select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken, so that each source comes to its target."""
    return mix_sources(docs)


STAGES = [
    ("language", known_language),
    ("near copies", one_of_each_group),
    ("repeated passages", without_repeats),
    ("benchmark", without_benchmark),
    ("mixture", mixed),
]

#: No SQL: the first stage fits a model, the last solves for rates.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = kept(docs)
    return docs
