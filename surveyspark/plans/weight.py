"""Stage two: margins, survey designs and post-stratified weights."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyspark.functions.labels import decode
from surveyspark.functions.reshape import any_of
from surveyspark.operators import demographics, linkage, margins
from surveyspark.operators.design import (
    SurveyDesign,
    adult_weights,
    equal_probability,
    member_weights,
    poststratify,
)
from surveyspark.sources.profile import Profile
from surveyspark.sources.tables import stage


@dataclass(frozen=True)
class Designs:
    """The five designs a report may draw on."""

    households: SurveyDesign
    households_with_foreigners: SurveyDesign
    members: SurveyDesign
    foreign_members: SurveyDesign
    foreign_adults: SurveyDesign


def population_by_origin(dem: DataFrame, countries: DataFrame, profile: Profile) -> DataFrame:
    return margins.by_origin(margins.in_scope(dem, profile), countries, profile)


def adult_rows(hh: DataFrame, countries: DataFrame, profile: Profile) -> DataFrame:
    """Foreign respondents with their post-stratum, answers decoded to text."""
    located = linkage.add_region(hh, countries, "origin")
    keyed = demographics.adult_stratum(decode(demographics.collapse_origin(located, profile)))
    return keyed.filter(F.col("origin") != profile.host)


def foreign_without_age(s1: DataFrame, profile: Profile) -> DataFrame:
    """Foreign members whose age is missing: they belong to no post-stratum."""
    return s1.filter(F.col("R03").isNull() & (F.col("origin") != profile.host))


def member_rows(s1: DataFrame, countries: DataFrame, profile: Profile,
                missing_age: str = "fail") -> DataFrame:
    """Foreign members with their post-stratum, answers decoded to text.

    A missing age has no margin. The job fails on one, as the survey has to say what
    becomes of it; ``missing_age="leave_out"`` leaves those members out
    (``foreign_without_age`` lists them).
    """
    if missing_age not in ("fail", "leave_out"):
        raise ValueError(f"missing_age: {missing_age}")
    if missing_age == "leave_out":
        s1 = s1.filter(F.col("R03").isNotNull())
    else:
        gap = F.col("R03").isNull() & (F.col("origin") != profile.host)
        s1 = s1.filter(F.when(gap, F.raise_error(F.lit("foreign member without age")).cast("boolean"))
                       .otherwise(F.lit(True)))
    located = linkage.add_region(s1, countries, "origin")
    binned = demographics.age_group(
        demographics.collapse_origin(located, profile), adult_from=profile.working_age)
    keyed = demographics.member_stratum(decode(binned))
    return keyed.filter(F.col("origin") != profile.host)


def adult_base_design(rows: DataFrame, margin: DataFrame) -> SurveyDesign:
    """One adult per household, finite population of the margin's size."""
    return SurveyDesign(
        adult_weights(rows, margin), weight="dweightAdultInd", fpc="fpcAdultInd", fpc_kind="size")


def member_base_design(rows: DataFrame, margin: DataFrame) -> SurveyDesign:
    """Households as clusters, sampling fraction of the persons."""
    return SurveyDesign(
        member_weights(rows, margin), weight="dweightHHM", psu="_parent_index",
        fpc="fpcHHM", fpc_kind="fraction")


def adult_design(hh: DataFrame, origins: DataFrame, countries: DataFrame,
                 profile: Profile) -> SurveyDesign:
    """Post-stratified adult design over a stored household table."""
    margin = stage(margins.adult_margin(origins, profile), "adult-margin")
    rows = adult_rows(hh, countries, profile)
    return poststratify(adult_base_design(rows, margin), "originSex_ps", margin)


def member_design(s1: DataFrame, origins: DataFrame, countries: DataFrame,
                  profile: Profile, missing_age: str = "fail") -> SurveyDesign:
    """Post-stratified member design over a stored member table."""
    margin = stage(margins.member_margin(origins, profile), "member-margin")
    rows = member_rows(s1, countries, profile, missing_age)
    return poststratify(member_base_design(rows, margin), "originAgeSex_ps", margin)


def staged(design: SurveyDesign, name: str, columns: Sequence[str] | None = None) -> SurveyDesign:
    """The design over its written rows, for many tables to read.

    ``columns`` limits the write to what the tables need beside the design's own.
    Rows keep their order: they are dealt by sampling unit where units are summed, once,
    as a written table does not keep how it was dealt.
    """
    df = design.df
    if columns is not None:
        own = [v for n, v in design.settings().items() if v and n != "fpc_kind"]
        df = df.select(*any_of(df, dict.fromkeys([*own, *columns])))
    return design.replace(df=stage(df, name))


def build_designs(hh: DataFrame, s1: DataFrame, dem: DataFrame, countries: DataFrame,
                  profile: Profile, columns: Sequence[str] | None = None,
                  missing_age: str = "fail") -> Designs:
    """All designs over clean tables.

    The tables must be stored ones: each design scans them a few times, with
    few columns. Post-stratified rows are written once more, because every
    table would otherwise repeat the weighting. The countries are written, so that the
    planner knows their bytes; by those of the plan behind them it would shuffle the
    interviews by origin.
    """
    countries = stage(countries, "countries")
    origins = stage(population_by_origin(dem, countries, profile), "origins")
    members = member_design(s1, origins, countries, profile, missing_age)
    adults = adult_design(hh, origins, countries, profile)
    return Designs(
        households=equal_probability(decode(hh)),
        households_with_foreigners=equal_probability(decode(hh.filter("allNationals = 0"))),
        members=equal_probability(decode(s1), psu="_parent_index"),
        foreign_members=staged(members, "foreign-members", columns),
        foreign_adults=staged(adults, "foreign-adults", columns),
    )
