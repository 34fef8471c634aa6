"""Frequency tables, duplicate checks and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surveyspark.functions.nulls import ratio
from surveyspark.functions.reshape import stack_tables
from surveyspark.sources.stages import stage


def share_of_total(counted: DataFrame, value: str, name: str = "perc") -> DataFrame:
    """Share of every row in the column total (one scalar for the table)."""
    total = counted.select(F.sum(value)).scalar()
    return counted.withColumn(name, ratio(F.col(value), total))


def share_within(counted: DataFrame, value: str, outer: Sequence[str], name: str) -> DataFrame:
    """Share of every row in its outer group, on counts already grouped."""
    total = F.sum(value).over(Window.partitionBy(*outer))
    return counted.withColumn(name, ratio(F.col(value), total))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """One-way table, missing values as a row of their own."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def distribution(df: DataFrame, column: str) -> DataFrame:
    """One-way table with shares, missing values included."""
    return share_of_total(frequency(df, column), "n")


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Two-way table in long form, missing values shown."""
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def proportions(df: DataFrame, column: str) -> DataFrame:
    """Shares of the non-missing values."""
    return share_of_total(frequency(df.filter(F.col(column).isNotNull()), column), "n")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows; a missing key counts as a value."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicated"))


#: fixed values: the points of a five-number summary
POINTS = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, missing values, five-number summary and mean of number columns.

    Exact, for any number of distinct values: counts of values are sorted over all
    tasks by range and written; the sums of the ranges tell which of them hold the
    wanted ranks, and only those are numbered. A point between two ranks is
    interpolated. A column without a value has only its counts.
    """
    counted = stack_tables([
        df.groupBy(F.col(c).cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(no).alias("no"), "v", "n") for no, c in enumerate(columns)])
    ranges = stage(
        counted.repartitionByRange("no", "v").sortWithinPartitions("no", "v")
        .withColumn("part", F.spark_partition_id()), "values")
    totals = ranges.groupBy("no").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("v").isNull(), F.col("n")).otherwise(0)).alias("n_missing"),
        F.sum(F.col("v") * F.col("n")).alias("_sum"))
    values = ranges.filter("v is not null")

    parts = values.groupBy("no", "part").agg(F.sum("n").alias("size"))
    before = Window.partitionBy("no").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    known = F.col("n_rows") - F.col("n_missing")
    place = F.explode(F.array(*[F.struct(F.lit(name).alias("point"), (q * (known - 1)).alias("at"))
                                for name, q in POINTS.items()]))
    points = totals.filter(known > 0).select("no", place.alias("p")).select(
        "no", "p.point", "p.at", F.explode(F.array_distinct(F.array(
            F.floor("p.at"), F.ceil("p.at")))).alias("rank"))
    held = points.join(parts, "no").filter("start <= rank and rank < start + size")

    inside = Window.partitionBy("no", "part").orderBy("v")
    needed = values.join(held.select("no", "part", "start").distinct(), ["no", "part"])
    numbered = needed.withColumn("end", F.col("start") + F.sum("n").over(inside)).withColumn(
        "begin", F.col("end") - F.col("n"))
    found = held.drop("start", "size").join(numbered.drop("start"), ["no", "part"]).filter(
        "begin <= rank and rank < end")
    share = F.when(F.floor("at") == F.ceil("at"), 1.0).when(
        F.col("rank") == F.floor("at"), F.ceil("at") - F.col("at")).otherwise(F.col("at") - F.floor("at"))
    marks = found.groupBy("no", "point").agg(F.sum(F.col("v") * share).alias("mark"))
    wide = marks.groupBy("no").agg(*[
        F.max(F.when(F.col("point") == name, F.col("mark"))).alias(name) for name in POINTS])
    names = F.array(*[F.lit(c) for c in columns])
    return totals.join(wide, "no", "left").select(
        F.element_at(names, F.col("no") + 1).alias("variable"), "n_rows", "n_missing", *POINTS,
        ratio(F.col("_sum"), known).alias("mean"))
