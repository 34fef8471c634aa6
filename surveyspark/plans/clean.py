"""Stage one: from linked raw tables to clean household and member tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from surveyspark.functions.reshape import any_of
from surveyspark.operators import demographics, household, indicators, linkage
from surveyspark.sources.profile import (
    HOUSEHOLD_IDENTIFIERS,
    HOUSEHOLD_WORK_COLUMNS,
    MEMBER_IDENTIFIERS,
    MEMBER_WORK_COLUMNS,
    Profile,
)
from surveyspark.sources.stages import stage, stage_counted

# What is carried between the two tables.
HOUSEHOLD_TO_MEMBERS = (
    "cookingfuel", "electricity", "basicSanitation", "basicDrinkingWater",
    "basicFacilities", "originAux2", "hhadults", "headHHindex",
)
MEMBER_TO_HOUSEHOLD = (
    "R02", "R02_rel", "R03", "R03cat", "R03cat2", "R06", "citizenship", "REF06",
    "countrybirth", "REF15", "REF16", "documents", "IDP01",
    "DIS01", "DIS02", "DIS03", "DIS04", "DIS05", "DIS06",
    "DISABILITY1", "DISABILITY2", "DISABILITY3", "DISABILITY4", "originAux",
)

# What linking needs of the written tables, whatever columns are asked for.
MEMBERS_BETWEEN = (
    "_index", "_parent_index", "member_no", "R02", "R02_rel", "R03", "R03cat", "citizenship", "REF06",
    "DISABILITY3", "originAux",
)
HOUSEHOLDS_BETWEEN = ("_form", "_index", "selected_adult", "hhsize", "employed", *HOUSEHOLD_TO_MEMBERS)


@dataclass(frozen=True)
class LinkChecks:
    """Rows on both sides of the link between households and members, counted while they were written.

    ``linked`` adds up the members that each household has. It is below ``members``
    where members have no household, above where a household key is repeated.
    """

    households: int
    households_after: int
    without_members: int
    members: int
    without_key: int
    linked: int

    @property
    def complete(self) -> bool:
        return self.households == self.households_after and self.members == self.linked

    def require(self) -> None:
        if not self.complete:
            raise ValueError(f"members and households do not match: {self}")


@dataclass(frozen=True)
class CleanTables:
    hh: DataFrame
    s1: DataFrame
    checks: LinkChecks | None = None


def derive_members(members: DataFrame, profile: Profile) -> DataFrame:
    """Demographics, functioning and documents; working columns removed."""
    out = demographics.age_bands(members)
    out = demographics.citizenship(out, profile)
    out = demographics.documents(demographics.disability(out))
    return out.drop("disSum234", "disSum34", "doc5plus", "doc04")


def household_base(households: DataFrame, members: DataFrame, profile: Profile,
                   origin_pick: str = "count", missing: str = "strict",
                   heads: Mapping[str, str] = household.HEAD_ATTRIBUTES) -> DataFrame:
    """Household form with its indicators and what the members add up to."""
    rolled = household.roll_up_with_head(members, profile, missing, heads)
    origin = household.household_origin(members, profile, origin_pick)
    both = rolled.join(origin, "_parent_index", "left").withColumnRenamed("_parent_index", "_hh")
    forms = indicators.household_services(households)
    return forms.join(both, F.col("_index") == F.col("_hh"), "left").drop("_hh")


def enrich_members(members: DataFrame, base: DataFrame, profile: Profile,
                   extra: Sequence[str] = ()) -> DataFrame:
    """Members with household indicators, head flag and imputed origin, in one join.

    ``extra`` names further columns of the household.
    """
    own = demographics.own_origin(members, profile)
    linked = linkage.push_down(own, base, (*HOUSEHOLD_TO_MEMBERS, *extra))
    marked = linked.withColumn("householdHead", household.head_flag("headHHindex"))
    return demographics.impute_origin(marked.drop("headHHindex"), profile)


def enrich_households(base: DataFrame, members: DataFrame, profile: Profile,
                      columns: Sequence[str] = MEMBER_TO_HOUSEHOLD) -> DataFrame:
    """Households with the respondent's attributes, labour force and origin."""
    have = [c for c in columns if c in members.columns]
    return with_respondent(linkage.link_respondent(base, members, have), profile)


def enrich_both(base: DataFrame, members: DataFrame, profile: Profile,
                columns: Sequence[str]) -> CleanTables:
    """Both tables with the given columns, the members written, each member joined to its household once.

    The rows are those of ``enrich_households`` and ``enrich_members``. A respondent is a member
    with the number that the form drew; the written members say whose respondent they are,
    so that households join their respondents only, not all members once more.
    ``base`` is a written table with the ``employment`` and a number ``_form`` of each row.
    """
    linked = linkage.strip_identifiers(
        enrich_members(members, base, profile, ("selected_adult", "_form")).withColumn(
            "_of", F.when(F.col("selected_adult") == F.col("member_no"), F.col("_form"))),
        MEMBER_IDENTIFIERS, MEMBER_WORK_COLUMNS)
    kept = any_of(linked, dict.fromkeys(columns))
    s1 = stage(linked.select("_of", *dict.fromkeys([*kept, "R03", "origin"])), "s1")
    have = [c for c in MEMBER_TO_HOUSEHOLD if c in s1.columns]
    respondents = s1.filter(F.col("_of").isNotNull()).select("_of", "origin", *have)
    own = base.join(respondents, F.col("_form") == F.col("_of"), "left")
    hh = linkage.strip_identifiers(
        indicators.labour_force(indicators.working_age(own, profile)), HOUSEHOLD_IDENTIFIERS, HOUSEHOLD_WORK_COLUMNS)
    return CleanTables(hh=hh.select(*any_of(hh, dict.fromkeys(columns))), s1=s1.select(*kept))


def with_respondent(linked: DataFrame, profile: Profile) -> DataFrame:
    """Labour force and origin of households beside their respondent's answers."""
    labour = indicators.labour_force(indicators.working_age(linked, profile))
    with_origin = demographics.impute_origin(labour, profile)
    # without a respondent the household's origin must not stand in
    own = F.when(F.col("_found"), F.col("origin"))
    meta = with_origin.schema["origin"].metadata
    return with_origin.withColumn("origin", own.alias("origin", metadata=meta)).drop("_found")


def clean(households: DataFrame, members: DataFrame, profile: Profile,
          origin_pick: str = "count", missing: str = "strict",
          keep_answers: bool = True, unmatched: str = "report",
          columns: Sequence[str] | None = None) -> CleanTables:
    """Both clean tables, identifiers and working columns removed.

    The derived members and the household base are read by several branches
    each, so they are written once and read back, without any identifier: names
    reach no file. ``keep_answers=False`` leaves out the raw answers that the
    derived columns stand for; ``columns`` leaves only the named ones, and the members are
    then a written table. Both writes count their rows and keys: ``checks`` holds
    the counts, and ``unmatched="fail"`` stops on a repeated household key or on
    members without a household.
    """
    if unmatched not in ("report", "fail"):
        raise ValueError(f"unmatched: {unmatched}")
    answers = () if keep_answers else (
        *demographics.FUNCTIONING, *demographics.DOCUMENTS_FROM_5, *demographics.DOCUMENTS_BELOW_5)
    members = members.drop(*MEMBER_IDENTIFIERS)
    households = households.drop(*HOUSEHOLD_IDENTIFIERS)
    rows = F.count(F.lit(1))
    derived, heads = derive_members(members, profile).drop(*answers), household.HEAD_ATTRIBUTES
    if columns is not None:
        derived = derived.select(*any_of(derived, dict.fromkeys([*MEMBERS_BETWEEN, *columns])))
        heads = {a: n for a, n in heads.items() if a == "_index" or n in columns}
    derived, of_members = stage_counted(derived, "members", {
        "members": rows, "without_key": F.count_if(F.col("_parent_index").isNull())})
    forms = Observation(f"forms-{uuid.uuid4().hex}")
    base = household_base(
        households.observe(forms, rows.alias("households")), derived, profile, origin_pick, missing, heads)
    if not keep_answers:
        base = base.drop(*indicators.SERVICE_ANSWERS)
    if columns is not None:
        base = indicators.employment(base).withColumn("_form", F.monotonically_increasing_id())
        base = base.select(*any_of(base, dict.fromkeys([*HOUSEHOLDS_BETWEEN, *columns])))
    base, of_base = stage_counted(base, "households", {
        "households_after": rows, "without_members": F.count_if(F.col("hhsize").isNull()), "linked": F.sum("hhsize")})
    checks = LinkChecks(households=forms.get["households"], **of_members, **of_base)
    if unmatched == "fail":
        checks.require()
    if columns is not None:
        return replace(enrich_both(base, derived, profile, columns), checks=checks)
    hh = enrich_households(base, derived, profile)
    s1 = enrich_members(derived, base, profile)
    return CleanTables(
        hh=linkage.strip_identifiers(hh, HOUSEHOLD_IDENTIFIERS, HOUSEHOLD_WORK_COLUMNS),
        s1=linkage.strip_identifiers(s1, MEMBER_IDENTIFIERS, MEMBER_WORK_COLUMNS),
        checks=checks,
    )
