"""A training-data pipeline over `documents`: five operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.llm.decontaminate import without_leaks
from surveyspark.llm.jaccard_join import one_of_each_group
from surveyspark.llm.language import known_languages
from surveyspark.llm.packing import pack_documents
from surveyspark.llm.queries import VOCABULARY, on_workers
from surveyspark.llm.scratch import Scratch
from surveyspark.llm.sentence_dedup import dedup_sentences


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of some language, with lang as predicted; texts without a letter go."""
    on_workers(spark)
    return known_languages(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least doc_id, of each component of near copies."""
    on_workers(spark)
    return one_of_each_group(docs, width=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without sentence spans that an earlier document has; texts left empty go."""
    on_workers(spark)
    cut = dedup_sentences(docs)
    return cut.filter((F.col("n_removed") == 0) | (F.col("text") != "")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    on_workers(spark)
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts, packed into sequences."""
    on_workers(spark)
    return pack_documents(docs, VOCABULARY)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: None of the stages can be stated in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return docs
