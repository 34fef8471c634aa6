"""Saved tables: survey designs on disk, report files."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from surveyspark.operators.design import SurveyDesign
from surveyspark.sources.stages import drop_stages, shared_dir, stage

__all__ = ["drop_stages", "load_design", "load_table", "save_designs", "save_report", "save_tables",
           "shared_dir", "stage"]

def save_tables(tables: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def load_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def save_designs(designs: Mapping[str, SurveyDesign], folder: str) -> None:
    """Design rows as Parquet, the design's columns as a small JSON table."""
    for name, design in designs.items():
        df = design.df
        kept = design
        if design.domain is not None:
            df = df.withColumn("_domain", design.domain)
            kept = design.replace(df=df, domain=None)
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        settings = json.dumps({**kept.settings(), "has_domain": design.domain is not None})
        spark = df.sparkSession
        spark.createDataFrame([(settings,)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{folder}/{name}.design")


def load_design(spark: SparkSession, folder: str, name: str) -> SurveyDesign:
    settings = json.loads(spark.read.text(f"{folder}/{name}.design").first()[0])
    has_domain = settings.pop("has_domain")
    design = SurveyDesign(df=spark.read.parquet(f"{folder}/{name}"), **settings)
    return design.filter("_domain") if has_domain else design


def save_report(report: DataFrame, folder: str, order: list[str]) -> None:
    """Report as Parquet and as one CSV file, rows in report order.

    The row count is fixed by the questionnaire, so one file is right.
    """
    shown = report.orderBy(*order).drop(*order)
    report.write.mode("overwrite").parquet(f"{folder}/report")
    shown.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/report_csv")
