"""Household roll-ups: head, size, nationals, modal origin.

Everything a household needs from its members comes out of ordinary grouped
aggregates. "The oldest member" is the maximum of a packed key (or of a small
struct, where answers travel with it) rather than a ranked window, so members are
combined on the map side and a household of any size never has to sit in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveyspark.functions.labels import labelled
from surveyspark.functions.nulls import cut, if_else_na, skip_sum, strict_sum
from surveyspark.sources.profile import Profile

# Household size classes, upper ends included.
SIZE_BOUNDS = (-1, 1, 3, 5)
SIZE_LABELS = ("1", "2-3", "4-5", "6+")
NATIONALS_LABELS = {0: "At least one non-national in HH", 1: "All HH members nationals"}
HEAD_LABELS = {1: "Head of household", 0: "Not head of household"}
HOUSEHOLD_DISABILITY_LABELS = {0: "Without disability", 1: "With disability"}

HEAD_ATTRIBUTES = {
    "_index": "headHHindex",
    "R02": "headHHR02",
    "R03": "headHHR03",
    "R03cat": "headHHR03cat",
    "R03cat2": "headHHR03cat2",
    "citizenship": "headHHcitizenship",
    "REF06": "headHHREF06",
}


def top_one(value: Column, by: Column, tie: Column) -> Column:
    """Value of the row with the largest ``by``; smallest ``tie`` on ties.

    A missing ``by`` ranks last, so a group without any still yields a row.
    """
    return F.max_by(value, F.struct(by, -tie))


#: numbers of members below this many fit beside an age in one 64-bit key
PLACES = 1 << 32


def age_key(age: Column, number: Column) -> Column:
    """One integer that rises with age and, on equal ages, falls with the member's number.

    A missing age ranks last. Its maximum is a hash aggregate, unlike that of a struct.
    """
    older = F.coalesce(age.cast("long") + 1, F.lit(0))
    return older * PLACES + (PLACES - 1 - number.cast("long"))


def head_choice(missing: str = "strict") -> Column:
    """Number of the household head, as an aggregate over the members.

    The oldest declared head, or the oldest member where none is declared.
    With ``missing="strict"`` one unanswered relation leaves the household
    without a head; ``"skip"`` ignores unanswered relations.
    """
    relation = F.col("R02_rel")
    rank = age_key(F.col("R03"), F.col("member_no"))
    best = F.coalesce(F.max(F.when(relation == "1", rank)), F.max(rank))
    head = PLACES - 1 - best.bitwiseAND(F.lit(PLACES - 1))
    if missing == "skip":
        return head
    return F.when(F.count(relation) == F.count(F.lit(1)), head)


def head_flag(head: str, own: str = "_index") -> Column:
    """1 for the member whose key is ``head``, 0 for others, NULL without a head."""
    flag = (F.col(own) == F.col(head)).cast("int")
    return labelled(flag, "householdHead", HEAD_LABELS, "Head of household")


def mark_heads(members: DataFrame, missing: str = "strict") -> DataFrame:
    """Add ``householdHead`` (1/0, NULL where the household has no clear head)."""
    heads = members.groupBy(F.col("_parent_index").alias("_hh")).agg(
        head_choice(missing).alias("_head"))
    return (
        members.join(heads, F.col("_parent_index") == F.col("_hh"), "left")
        .withColumn("householdHead", head_flag("_head", "member_no"))
        .drop("_hh", "_head")
    )


def roll_up(members: DataFrame, profile: Profile, missing: str = "strict",
            extra: Sequence[Column] = ()) -> DataFrame:
    """One row per household: size, adults, nationals, disability, and extras."""
    total = strict_sum if missing == "strict" else skip_sum
    counted = members.groupBy("_parent_index").agg(
        F.count(F.lit(1)).alias("hhsize"),
        total(F.col("DISABILITY3") == 1).alias("_disabled"),
        total(F.col("citizenship") == profile.host).alias("hhNationals"),
        total(F.col("R03") >= profile.working_age).alias("hhadults"),
        *extra,
    )
    disabled = if_else_na(F.col("_disabled") > 0, 1, 0)
    all_nationals = if_else_na(F.col("hhsize") == F.col("hhNationals"), 1, 0)
    return counted.withColumns({
        "hhdisability3": labelled(
            disabled, "hhdisability3", HOUSEHOLD_DISABILITY_LABELS,
            "Washington Group disability identifier 3 for household level"),
        "hhsizecat": cut("hhsize", SIZE_BOUNDS, SIZE_LABELS).alias(
            "hhsizecat", metadata={"label": "", "texts": list(SIZE_LABELS)}),
        "allNationals": labelled(
            all_nationals, "allNationals", NATIONALS_LABELS, "National citizens in HH"),
    }).drop("_disabled")


def roll_up_with_head(members: DataFrame, profile: Profile, missing: str = "strict",
                      attributes: Mapping[str, str] = HEAD_ATTRIBUTES) -> DataFrame:
    """Household roll-up together with the head's attributes, in one grouping.

    The same rows as joining the members marked as head, but without marking
    or joining: the head's columns travel behind the rank in the struct whose maximum
    is the head, once for declared heads and oldest members alike.
    """
    relation = F.col("R02_rel")
    behind = [F.col(a).alias(a) for a in attributes if a not in ("R03", "_index")]
    top = F.max(F.struct(
        F.coalesce(relation == "1", F.lit(False)).alias("declared"), "R03", (-F.col("_index")).alias("before"), *behind))
    head = F.struct(*[(-top["before"] if a == "_index" else top[a]).alias(n) for a, n in attributes.items()])
    if missing == "strict":
        head = F.when(F.count(relation) == F.count(F.lit(1)), head)
    rolled = roll_up(members, profile, missing, extra=[head.alias("_head")])
    meta = {n: members.schema[a].metadata for a, n in attributes.items()}
    return rolled.select(
        *[c for c in rolled.columns if c != "_head"],
        *[F.col(f"_head.{n}").alias(n, metadata=meta[n]) for n in attributes.values()],
    )


def attach_head(rolled: DataFrame, marked: DataFrame) -> DataFrame:
    """Join the attributes of the marked heads to the household roll-up."""
    heads = marked.filter(F.col("householdHead") == 1).select(
        F.col("_parent_index").alias("_hh"),
        *[F.col(a).alias(n) for a, n in HEAD_ATTRIBUTES.items()])
    return rolled.join(heads, F.col("_parent_index") == F.col("_hh"), "left").drop("_hh")


def household_origin(members: DataFrame, profile: Profile, pick: str = "count") -> DataFrame:
    """One foreign origin per household.

    ``pick="count"`` takes the most frequent one (ties: last code),
    ``pick="value"`` the last code outright.
    """
    foreign = members.select(
        "_parent_index",
        if_else_na(F.col("originAux") == profile.host, None, F.col("originAux")).alias("originAux2"),
    ).filter(F.col("originAux2").isNotNull())
    if pick == "value":
        return foreign.groupBy("_parent_index").agg(
            F.max("originAux2").alias("originAux2"))
    # counts by origin travel in the household's one row; descending: the last code on ties
    return foreign.groupBy("_parent_index").agg(
        F.expr("mode() WITHIN GROUP (ORDER BY originAux2 DESC)").alias("originAux2"))


def not_host(df: DataFrame, profile: Profile, column: str = "origin") -> DataFrame:
    """Rows of another origin than the host country; a missing origin is dropped."""
    return df.filter(F.col(column) != profile.host)


def not_host_or_blank(df: DataFrame, profile: Profile, column: str = "origin") -> DataFrame:
    """As ``not_host``, but a row without origin stays as an all-missing row."""
    kept = df.filter(F.coalesce(F.col(column) != profile.host, F.lit(True)))
    known = F.col(column).isNotNull()
    return kept.select(*[F.when(known, F.col(f"`{c}`")).alias(c) for c in df.columns])
