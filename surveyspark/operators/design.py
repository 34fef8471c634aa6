"""Survey designs: weights, sampling units, finite population, post-strata."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyspark.functions.nulls import ratio
from surveyspark.sources.stages import stage


@dataclass(frozen=True)
class SurveyDesign:
    """Rows plus the columns that say how they were sampled.

    ``psu`` is None when every row is its own sampling unit. ``domain`` marks
    the rows a table is about; the others stay, because their units and
    post-strata still count in the variance.
    """

    df: DataFrame
    weight: str
    psu: str | None = None
    fpc: str | None = None
    fpc_kind: str = "size"
    stratum: str | None = None
    domain: Column | None = None

    def replace(self, **changes: object) -> SurveyDesign:
        return dataclasses.replace(self, **changes)

    def filter(self, condition: Column | str) -> SurveyDesign:
        """Restrict to a domain; a missing condition is out of it."""
        condition = F.expr(condition) if isinstance(condition, str) else condition
        inside = F.coalesce(condition, F.lit(False))
        both = inside if self.domain is None else self.domain & inside
        return self.replace(domain=both)

    def with_columns(self, columns: dict[str, Column]) -> SurveyDesign:
        return self.replace(df=self.df.withColumns(columns))

    def settings(self) -> dict[str, str | None]:
        names = ("weight", "psu", "fpc", "fpc_kind", "stratum")
        return {n: getattr(self, n) for n in names}


def equal_probability(df: DataFrame, psu: str | None = None) -> SurveyDesign:
    """Every row stands for itself."""
    return SurveyDesign(df.withColumn("weight", F.lit(1.0)), weight="weight", psu=psu)


def strict_total(column: str) -> Column:
    """Sum of a number column, NULL when one value is missing."""
    return F.when(F.count(column) == F.count(F.lit(1)), F.sum(column)).cast("double")


def margin_total(margin: DataFrame) -> Column:
    """Size of the population, as one scalar."""
    return margin.select(F.sum("Freq").cast("double")).scalar()


def adult_weights(df: DataFrame, margin: DataFrame, adults: str = "hhadults") -> DataFrame:
    """One adult per household drawn at random: weight grows with the adults.

    Scaled so that all adults of the sampled households stand for the margin.
    """
    population = margin_total(margin)
    drawn_from = df.select(strict_total(adults)).scalar()
    chance = ratio(F.lit(1), F.col(adults)) * ratio(drawn_from, population)
    return (
        df.withColumn("selectionprob", chance)
        .withColumn("dweightAdultInd", ratio(F.lit(1), F.col("selectionprob")))
        .withColumn("fpcAdultInd", population)
    )


def member_weights(df: DataFrame, margin: DataFrame) -> DataFrame:
    """All members of sampled households: one constant weight."""
    population = margin_total(margin)
    sampled = df.select(F.count(F.lit(1)).cast("double")).scalar()
    return df.withColumns({
        "dweightHHM": ratio(population, sampled),
        "fpcHHM": ratio(sampled, population),
    })


def post_strata_factors(df: DataFrame, weight: str, key: str, margin: DataFrame) -> DataFrame:
    """Factor per post-stratum that lifts its weight to the margin.

    A stratum on one side only makes the job fail.
    """
    sampled = df.groupBy(F.col(key).alias("_h")).agg(F.sum(weight).alias("_w"))
    target = margin.select(F.col(key).alias("_m"), F.col("Freq").cast("double").alias("_freq"))
    both = sampled.join(target, F.col("_h").eqNullSafe(F.col("_m")), "full")
    unmatched = F.col("_w").isNull() | F.col("_freq").isNull()
    message = F.concat(
        F.lit("post-stratum not in both sample and margin: "),
        F.coalesce("_h", "_m", F.lit("missing")))
    factor = F.when(unmatched, F.raise_error(message).cast("double")).otherwise(
        ratio("_freq", "_w"))
    return both.select(F.coalesce("_h", "_m").alias(key), factor.alias("_factor"))


def poststratify(design: SurveyDesign, key: str, margin: DataFrame,
                 name: str = "weight_ps") -> SurveyDesign:
    """Scale weights so that every post-stratum adds up to its margin count.

    The factors have one row per margin row. They are written, so the planner
    knows their bytes and broadcasts them below its threshold, else shuffles.
    """
    factors = stage(post_strata_factors(design.df, design.weight, key, margin), "factors")
    df = design.df.join(factors, key).withColumn(
        name, F.col(design.weight) * F.col("_factor")).drop("_factor")
    return design.replace(df=df, weight=name, stratum=key)


def calibration(design: SurveyDesign, margin: DataFrame) -> DataFrame:
    """Weighted totals by post-stratum beside the margin they must meet."""
    key = design.stratum
    totals = design.df.groupBy(key).agg(
        F.sum(design.weight).alias("weighted"), F.count(F.lit(1)).alias("unwn"))
    return margin.join(totals, key, "left").select(
        key, F.col("Freq").cast("long").alias("Freq"), "unwn", "weighted",
        (F.abs(F.col("weighted") - F.col("Freq")) < 1e-6 * F.col("Freq")).alias("matches"))

