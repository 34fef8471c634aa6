"""Stage one straight from nested submissions: both clean tables without a join or a shuffle.

A submission holds its household form and the roster as an array. Whatever a household
needs of its members (head, size, nationals, modal origin, the respondent's answers) is
taken from the array, and whatever members need of the household travels with them when
the array is exploded. Rows never leave the task that reads them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from surveyspark.functions.labels import labelled
from surveyspark.functions.nulls import cut, if_else_na
from surveyspark.operators import demographics, household, indicators, linkage
from surveyspark.plans.clean import (
    HOUSEHOLD_TO_MEMBERS,
    MEMBER_TO_HOUSEHOLD,
    CleanTables,
    with_respondent,
)
from surveyspark.sources.profile import (
    HOUSEHOLD_IDENTIFIERS,
    HOUSEHOLD_WORK_COLUMNS,
    MEMBER_IDENTIFIERS,
    MEMBER_WORK_COLUMNS,
    Profile,
)

ROSTER = "_roster"


def _rules(get: demographics.Get, sums: demographics.Get, profile: Profile) -> dict[str, Column]:
    """All derived answers of a member that leave the stage."""
    rules = {
        **demographics.age_band_rules(get), **demographics.citizenship_rules(get, profile),
        **demographics.disability_rules(get, sums), **demographics.document_rules(get)}
    return {n: c for n, c in rules.items() if n not in ("disSum234", "disSum34", "doc5plus", "doc04")}


def derived_roster(submissions: DataFrame, roster: str, profile: Profile) -> DataFrame:
    """Submissions whose roster entries hold their number, answers and derived answers.

    A missing roster is an empty one. Names are dropped here.
    """
    kind = submissions.schema[roster].dataType
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType)):
        raise ValueError(f"{roster} is not a repeat group")
    asked = [n for n in kind.elementType.names if n not in MEMBER_IDENTIFIERS]

    def summed(member: Column) -> Column:
        sums = demographics.functioning_sums(lambda n: member[n])
        return F.struct(member.alias("answers"), *[c.alias(n) for n, c in sums.items()])

    def entry(known: Column, place: Column) -> Column:
        member = known["answers"]
        derived = _rules(lambda n: member[n], lambda n: known[n], profile)
        return F.struct((place + 1).alias("member_no"), *[member[n].alias(n) for n in asked],
                        *[c.alias(n) for n, c in derived.items()])

    # expressions on entries are not shared: the sums, read by several rules, get a pass of their own
    entries = F.transform(F.transform(F.coalesce(F.col(roster), F.array()), summed), entry)
    return submissions.withColumn(ROSTER, entries).drop(roster)


def _count(hit: Callable[[Column], Column], missing: str) -> Column:
    """Entries with a true condition; with ``strict`` NULL as soon as one condition is."""
    found = F.size(F.filter(ROSTER, lambda m: F.coalesce(hit(m), F.lit(False)))).cast("long")
    if missing == "skip":
        return found
    return F.when(~F.exists(ROSTER, lambda m: hit(m).isNull()), found)


def head_number(missing: str = "strict") -> Column:
    """Number of the oldest declared head, or of the oldest member where none is declared.

    On equal ages the first entry; a missing age ranks last.
    """
    def oldest(entries: Column) -> Column:
        return -F.array_max(F.transform(entries, lambda m: F.struct(
            m["R03"].alias("age"), (-m["member_no"]).alias("place"))))["place"]

    declared = F.filter(ROSTER, lambda m: F.coalesce(m["R02_rel"] == "1", F.lit(False)))
    head = F.coalesce(oldest(declared), oldest(F.col(ROSTER)))
    if missing == "skip":
        return head
    return F.when(~F.exists(ROSTER, lambda m: m["R02_rel"].isNull()), head)


def modal_origin(profile: Profile, pick: str = "count") -> Column:
    """The household's foreign origin, as ``household.household_origin`` picks it."""
    codes = F.filter(F.transform(ROSTER, lambda m: m["originAux"]),
                     lambda c: F.coalesce(c != profile.host, F.lit(False)))
    if pick == "value":
        return F.array_max(codes)
    counted = F.transform(F.array_distinct(codes), lambda c: F.struct(
        F.size(F.filter(codes, lambda other: other == c)).alias("n"), c.alias("code")))
    return F.array_max(counted)["code"]


def household_summary(df: DataFrame, profile: Profile, origin_pick: str, missing: str) -> DataFrame:
    """Size, nationals, adults, disability, origin and head of every roster; an empty one has none."""
    names = df.schema[ROSTER].dataType.elementType.names
    out = df.withColumns({
        "hhsize": F.size(ROSTER).cast("long"),
        "hhNationals": _count(lambda m: m["citizenship"] == profile.host, missing),
        "hhadults": _count(lambda m: m["R03"] >= profile.working_age, missing),
        "_disabled": _count(lambda m: m["DISABILITY3"] == 1, missing),
        "originAux2": modal_origin(profile, origin_pick), "headHHno": head_number(missing),
    })
    head = F.get(ROSTER, F.col("headHHno") - 1)
    all_nationals = if_else_na(F.col("hhsize") == F.col("hhNationals"), 1, 0)
    disabled = if_else_na(F.col("_disabled") > 0, 1, 0)
    some = F.size(ROSTER) > 0
    out = out.withColumns({
        "hhdisability3": labelled(
            F.when(some, disabled), "hhdisability3", household.HOUSEHOLD_DISABILITY_LABELS,
            "Washington Group disability identifier 3 for household level"),
        "hhsizecat": F.when(some, cut("hhsize", household.SIZE_BOUNDS, household.SIZE_LABELS)).alias(
            "hhsizecat", metadata={"label": "", "texts": list(household.SIZE_LABELS)}),
        "allNationals": labelled(F.when(some, all_nationals), "allNationals", household.NATIONALS_LABELS,
                                 "National citizens in HH"),
        **{new: demographics.with_labels(head[old], new, old)
           for old, new in household.HEAD_ATTRIBUTES.items() if old in names},
    })
    return out.withColumns({c: F.when(some, F.col(c)) for c in ("hhsize", "hhNationals", "hhadults")}).drop("_disabled")


def clean_from_submissions(submissions: DataFrame, profile: Profile, roster: str = "S1A", key: str = "_id",
                           origin_pick: str = "count", missing: str = "strict",
                           selected: str = "selected_adult") -> CleanTables:
    """Both clean tables of nested submissions, identifiers and working columns removed.

    Households are keyed by ``_index``, the submission's key; members by
    ``_parent_index`` and ``member_no``, the entry's place. The rules are those of
    ``clean.clean``. A form without a drawn respondent, or with a number beyond the
    roster, has none; a submission without roster is a household without members.
    """
    forms = submissions.withColumnRenamed(key, "_index").drop(*HOUSEHOLD_IDENTIFIERS)
    full = household_summary(derived_roster(forms, roster, profile), profile, origin_pick, missing)
    full = indicators.household_services(full)

    names = full.schema[ROSTER].dataType.elementType.names
    carried = [c for c in HOUSEHOLD_TO_MEMBERS if c in full.columns]
    # from an inner inline Spark infers a filter that derives the whole roster once more
    exploded = full.select(
        F.col("_index").alias("_parent_index"), "headHHno", *carried, F.inline_outer(ROSTER)
    ).filter(F.col("member_no").isNotNull())
    flag = labelled((F.col("member_no") == F.col("headHHno")).cast("int"), "householdHead",
                    household.HEAD_LABELS, "Head of household")
    derived = {n: demographics.with_labels(F.col(n), n) for n in demographics.MEMBER_LABELS}
    members = demographics.impute_origin(
        exploded.withColumns(derived).withColumn("householdHead", flag).drop("headHHno"), profile)

    answered = F.get(ROSTER, F.col(selected).cast("int") - 1)
    respondent = {c: demographics.with_labels(answered[c], c) for c in MEMBER_TO_HOUSEHOLD if c in names}
    linked = full.withColumns({**respondent, "_found": answered.isNotNull()}).drop(ROSTER)
    return CleanTables(
        hh=linkage.strip_identifiers(with_respondent(linked, profile), HOUSEHOLD_IDENTIFIERS, HOUSEHOLD_WORK_COLUMNS),
        s1=linkage.strip_identifiers(members, MEMBER_IDENTIFIERS, MEMBER_WORK_COLUMNS))
