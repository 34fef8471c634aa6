"""Named queries over the test tables, one or more per survey operator."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyspark.functions.labels import decode, decode_from
from surveyspark.functions.reshape import any_of, column_range
from surveyspark.operators import demographics, household, indicators, linkage, margins, quality
from surveyspark.operators.design import (
    SurveyDesign,
    calibration,
    equal_probability,
    poststratify,
)
from surveyspark.operators.estimate import Breakdown, design_total, estimate, with_limits
from surveyspark.plans import clean, report, weight
from surveyspark.plans.submissions import clean_from_submissions
from surveyspark.session import tune
from surveyspark.sources import forms, standin
from surveyspark.sources.profile import (
    HOUSEHOLD_IDENTIFIERS,
    HOUSEHOLD_WORK_COLUMNS,
    MEMBER_IDENTIFIERS,
    MEMBER_WORK_COLUMNS,
)
from surveyspark.sources.standin import PROFILE
from surveyspark.sources.tables import load_design, load_table, save_designs, save_tables, shared_dir, stage

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FUNCTIONING = list(demographics.FUNCTIONING)
MEMBER_COLUMNS = ["R03cat", "DISABILITY3", "documents"]
ADULT_COLUMNS = ["R02", "R03", "R03cat", "R03cat2", "DISABILITY3", "hhadults", "SAF01SDG", "INC01",
                 "labourForce", "employmentStatus"]
HOUSEHOLD_COLUMNS = ["hhsizecat", "electricity", "allNationals", "headHHR02", "headHHR03cat",
                     "hhdisability3"]
DOCUMENTS = [*demographics.DOCUMENTS_FROM_5, *demographics.DOCUMENTS_BELOW_5]


def query(f: Query) -> Query:
    @functools.wraps(f)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        tune(spark)
        return f(spark, sf)

    QUERIES[f.__name__] = run
    return run


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- shared inputs -----------------------------------------------------------

def derived(spark: SparkSession, sf: str, items: DataFrame | None = None) -> DataFrame:
    """Derived member columns without the raw answers behind them."""
    members = clean.derive_members(standin.members(spark, sf, items=items), PROFILE)
    return members.drop("R01", *FUNCTIONING, *DOCUMENTS)


def member_origin(spark: SparkSession, sf: str) -> DataFrame:
    """Members with citizenship and the origin it implies, nothing else."""
    return demographics.citizenship(standin.members(spark, sf, questions=()), PROFILE)


def respondents(spark: SparkSession, sf: str) -> DataFrame:
    """Household forms beside the respondent's age."""
    items = standin.roster(spark, sf, origins=False)
    members = standin.members(spark, sf, questions=(), origins=False, items=items)
    return linkage.link_respondent(standin.households(spark, sf, items=items), members, ["R03"])


def base_and_members(spark: SparkSession, sf: str, missing: str = "strict") -> tuple[DataFrame, DataFrame]:
    items = standin.roster(spark, sf)
    members = stage(derived(spark, sf, items), "members")
    base = clean.household_base(standin.households(spark, sf, items=items), members, PROFILE, missing=missing)
    return base, members


def origins(spark: SparkSession, sf: str) -> DataFrame:
    return weight.population_by_origin(
        standin.population(spark, sf), standin.countries(spark, sf), PROFILE)


def households_clean(spark: SparkSession, sf: str, missing: str = "strict") -> DataFrame:
    base, members = base_and_members(spark, sf, missing)
    return clean.enrich_households(base, members, PROFILE)


def members_with_origin(spark: SparkSession, sf: str, *columns: str, members: DataFrame | None = None) -> DataFrame:
    """Members with imputed origin, for tables that need nothing of the household form.

    ``members`` are the written ones of ``base_and_members``, if the caller has them.
    """
    if members is None:
        source = derived(spark, sf) if columns else member_origin(spark, sf)
        members = stage(source.select(
            "_index", "_parent_index", "R02", "R03", "REF06", "citizenship", "originAux", *columns), "members")
    modal = household.household_origin(members, PROFILE).withColumnRenamed("_parent_index", "_index")
    return demographics.impute_origin(linkage.push_down(members, modal, ["originAux2"]), PROFILE)


def member_design_base(spark: SparkSession, sf: str, *columns: str,
                       members: DataFrame | None = None) -> tuple[SurveyDesign, DataFrame]:
    """Member design before post-stratification, with its margin."""
    margin = stage(margins.member_margin(origins(spark, sf), PROFILE), "member-margin")
    s1 = members_with_origin(spark, sf, *columns, members=members).select(
        "_index", "_parent_index", "origin", "R02", "R03", *columns)
    rows = weight.member_rows(s1, standin.countries(spark, sf), PROFILE, missing_age="leave_out")
    return weight.member_base_design(stage(rows, "member-rows"), margin), margin


def adult_design_base(spark: SparkSession, sf: str,
                      tables: tuple[DataFrame, DataFrame] | None = None) -> tuple[SurveyDesign, DataFrame]:
    """Adult design before post-stratification, with its margin.

    ``tables`` are those of ``base_and_members`` with missing="skip", if the caller has them.
    """
    margin = stage(margins.adult_margin(origins(spark, sf), PROFILE), "adult-margin")
    base, members = base_and_members(spark, sf, "skip") if tables is None else tables
    hh = clean.enrich_households(base, members, PROFILE).select("_index", "origin", *ADULT_COLUMNS)
    rows = weight.adult_rows(hh, standin.countries(spark, sf), PROFILE)
    return weight.adult_base_design(stage(rows, "adult-rows"), margin), margin


def member_design_ps(spark: SparkSession, sf: str, *columns: str, members: DataFrame | None = None) -> SurveyDesign:
    design, margin = member_design_base(spark, sf, *columns, members=members)
    return poststratify(design, "originAgeSex_ps", margin)


def adult_design_ps(spark: SparkSession, sf: str,
                    tables: tuple[DataFrame, DataFrame] | None = None) -> SurveyDesign:
    design, margin = adult_design_base(spark, sf, tables)
    return poststratify(design, "originSex_ps", margin)


# --- households and links ----------------------------------------------------

@query
def head_of_household(spark, sf):
    members = standin.members(spark, sf, questions=(), origins=False)
    return household.mark_heads(members).select("_parent_index", "_index", "householdHead")


@query
def household_rollup(spark, sf):
    members = standin.members(spark, sf, questions=FUNCTIONING)
    members = demographics.citizenship(demographics.disability(members), PROFILE)
    return household.roll_up(members, PROFILE)


@query
def head_attributes(spark, sf):
    members = standin.members(spark, sf, questions=FUNCTIONING)
    members = demographics.age_bands(demographics.citizenship(
        demographics.disability(members), PROFILE))
    rolled = household.roll_up_with_head(members, PROFILE)
    return rolled.select("_parent_index", *household.HEAD_ATTRIBUTES.values())


@query
def household_origin_by_count(spark, sf):
    return household.household_origin(member_origin(spark, sf), PROFILE, pick="count")


@query
def household_origin_by_value(spark, sf):
    return household.household_origin(member_origin(spark, sf), PROFILE, pick="value")


@query
def origin_imputation(spark, sf):
    return members_with_origin(spark, sf).select(
        "_index", "citizenship", "originAux", "originAux2", "origin")


@query
def age_bands(spark, sf):
    members = standin.members(spark, sf, questions=(), origins=False)
    return demographics.age_bands(members).select("_index", "R03", "R03cat", "R03cat2")


@query
def disability_identifiers(spark, sf):
    members = standin.members(spark, sf, questions=FUNCTIONING, origins=False)
    out = demographics.disability(demographics.functioning_flags(members))
    flags = [f"disaux{i}_{k}" for i in range(1, 7) for k in ("234", "34")]
    return out.select("_index", *flags, "disSum234", "disSum34",
                      "DISABILITY1", "DISABILITY2", "DISABILITY3", "DISABILITY4")


@query
def region_lookup(spark, sf):
    located = linkage.add_region(
        member_origin(spark, sf), standin.countries(spark, sf), "citizenship")
    return located.groupBy("citizenship", "originHcrRegion").agg(F.count(F.lit(1)).alias("n"))


def two_roster_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The roster as two repeat groups that share only name and age."""
    members = standin.members(spark, sf, questions=FUNCTIONING, origins=False,
                              items=standin.roster(spark, sf, origins=False))
    part_a = members.select("_index", "_parent_index", "member_no", "R01", "R02", "R03")
    part_b = members.select(
        "_parent_index", F.col("R01").alias("name_individual"), F.col("R03").alias("ind_age_year"),
        "member_no", "R02_rel", "DIS01")
    return part_a, part_b


@query
def roster_merge(spark, sf):
    part_a, part_b = two_roster_parts(spark, sf)
    keys = {"_parent_index": "_parent_index", "R01": "name_individual", "R03": "ind_age_year"}
    merged = linkage.merge_rosters(part_a, part_b, keys)
    return merged.withColumn("indid2", linkage.roster_key("_parent_index", "R01", "R03"))


@query
def respondent_attributes(spark, sf):
    items = standin.roster(spark, sf, origins=False)
    members = standin.members(spark, sf, questions=(), origins=False, items=items)
    forms_ = standin.households(spark, sf, items=items).select("_index", "selected_adult")
    linked = linkage.link_respondent(forms_, members, ["R02", "R02_rel", "R03"])
    return linked.withColumn("indid", linkage.respondent_key("_index", "selected_adult")).drop("_found")


@query
def household_enriched(spark, sf):
    hh = households_clean(spark, sf)
    return hh.select(
        "_index", "hhsize", "hhadults", "hhdisability3", "hhsizecat", "allNationals",
        "headHHR02", "headHHR03", "headHHR03cat", "headHHcitizenship", "originAux2",
        "R02", "R03", "citizenship", "documents", "DISABILITY3", "origin",
        "workingAge", "labourForce", "employmentStatus", "basicFacilities")


@query
def member_enriched(spark, sf):
    base, members = base_and_members(spark, sf)
    s1 = clean.enrich_members(members, base, PROFILE)
    return s1.select(
        "_index", "_parent_index", "householdHead", "cookingfuel", "electricity",
        "basicSanitation", "basicDrinkingWater", "basicFacilities", "originAux2",
        "hhadults", "origin")


@query
def natural_join(spark, sf):
    members = standin.members(spark, sf, questions=(), origins=False)
    narrow = members.select("_index", "_parent_index", "R03")
    oldest = narrow.groupBy("_parent_index").agg(
        household.top_one(F.col("_index"), F.col("R03"), F.col("_index")).alias("_index"),
        F.lit(1).alias("oldestHHM"))
    return linkage.natural_left_join(narrow, oldest)


@query
def checked_join(spark, sf):
    members = standin.members(spark, sf, questions=(), origins=False).select(
        "_index", "_parent_index")
    sizes = members.groupBy("_parent_index").agg(F.count(F.lit(1)).alias("hhsize"))
    return linkage.checked_left_join(members, sizes, ["_parent_index"])


@query
def deidentified(spark, sf):
    return linkage.strip_identifiers(
        standin.households(spark, sf), HOUSEHOLD_IDENTIFIERS, HOUSEHOLD_WORK_COLUMNS)


@query
def deidentified_members(spark, sf):
    members = standin.members(spark, sf, questions=FUNCTIONING)
    return linkage.strip_identifiers(members, MEMBER_IDENTIFIERS, MEMBER_WORK_COLUMNS)


@query
def decoded_labels(spark, sf):
    shown = ["R03cat", "R03cat2", "DISABILITY1", "DISABILITY4", "documents"]
    out = decode(members_with_origin(spark, sf, *shown)).select("_index", *shown, "citizenship", "origin")
    return decode_from(out, ["citizenship", "origin"], standin.countries(spark, sf), "iso3", "name",
                       demographics.NO_COUNTRY_LABELS)


def submissions(spark: SparkSession, sf: str) -> DataFrame:
    """Nested submissions as JSON text: one record per household, as the form lands it."""
    items = standin.numbered_items(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_quantity", "member_no")
    entry = F.struct("member_no", F.col("l_linenumber").alias("R02_rel"), F.col("l_quantity").alias("R03"))
    grouped = items.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(entry)).alias("S1A"))
    record = F.struct(
        F.col("l_orderkey").alias("_id"),
        F.transform("S1A", lambda e: F.struct(
            e["R02_rel"].cast("string").alias("R02_rel"), e["R03"].cast("int").alias("R03"))
        ).alias("S1A"))
    return grouped.select(F.to_json(record).alias("value"))


SUBMISSION_SCHEMA = "_id bigint, S1A array<struct<R02_rel: string, R03: int>>"


@query
def submissions_flatten(spark, sf):
    parsed = submissions(spark, sf).select(
        F.from_json("value", SUBMISSION_SCHEMA).alias("s")).select("s.*")
    flat = forms.flatten(parsed, ["S1A"])["S1A"]
    key = F.col("_parent_index") * standin.MEMBER_STRIDE + F.col("member_no")
    return flat.select(key.alias("_index"), "*")


@query
def join_checks(spark, sf):
    """Rows on both sides of the household link, counted while the clean tables were written."""
    items = standin.roster(spark, sf)
    checks = clean.clean(
        standin.households(spark, sf, items=items), standin.members(spark, sf, items=items), PROFILE,
        missing="skip", keep_answers=False, unmatched="fail").checks
    return spark.createDataFrame([(n, int(v)) for n, v in vars(checks).items()], "measure string, n long")


@query
def design_roundtrip(spark, sf):
    """A table of an adult design with a domain that was written and loaded again."""
    design = adult_design_ps(spark, sf).filter("labourForce = 'In the labour force'")
    folder = f"{shared_dir(spark)}/designs-{uuid.uuid4().hex}"
    save_designs({"adults": design}, folder)
    back = load_design(spark, folder, "adults")
    return _cells(estimate(back, "SAF01SDG", report.PERSON_BREAKDOWNS[:1]), "p", "se", "df")


@query
def saved_tables(spark, sf):
    """Members written and read back: rows and refused questions by age band, whose labels came along."""
    members = demographics.age_bands(standin.members(spark, sf, questions=FUNCTIONING, origins=False))
    folder = f"{shared_dir(spark)}/tables-{uuid.uuid4().hex}"
    save_tables({"s1": members}, folder)
    back = load_table(spark, folder, "s1")
    asked = column_range(back, FUNCTIONING[0], FUNCTIONING[-1])
    refused = sum((F.count_if(F.col(c).isin("98", "99")) for c in asked), F.lit(0))
    return decode(back).groupBy("R03cat").agg(F.count(F.lit(1)).alias("n"), refused.cast("long").alias("refusals"))


def whole_submissions(spark: SparkSession, sf: str) -> DataFrame:
    """Every household's form with its members nested, as a form server would hand them out."""
    items = standin.roster(spark, sf)
    members = standin.members(spark, sf, items=items).drop("_index")
    names = [c for c in members.columns if c not in ("_parent_index", "member_no")]
    entry = F.struct("member_no", F.struct(*names).alias("answers"))
    rosters = members.groupBy(F.col("_parent_index").alias("_hh")).agg(
        F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["answers"]).alias("S1A"))
    forms_ = standin.households(spark, sf, items=items)
    return (forms_.join(rosters, F.col("_index") == F.col("_hh"), "left").drop("_hh")
            .withColumnRenamed("_index", "_id"))


@query
def households_from_submissions(spark, sf):
    hh = clean_from_submissions(whole_submissions(spark, sf), PROFILE).hh
    return hh.select(
        "_index", "hhsize", "hhadults", "hhdisability3", "hhsizecat", "allNationals",
        "headHHR02", "headHHR03", "headHHR03cat", "headHHcitizenship",
        "R02", "R03", "citizenship", "documents", "DISABILITY3", "origin",
        "workingAge", "labourForce", "employmentStatus", "basicFacilities")


@query
def members_from_submissions(spark, sf):
    s1 = clean_from_submissions(whole_submissions(spark, sf), PROFILE).s1
    return s1.select(
        "_parent_index", "member_no", "householdHead", "cookingfuel", "electricity",
        "basicSanitation", "basicDrinkingWater", "basicFacilities", "hhadults", "origin")


# --- indicators --------------------------------------------------------------

@query
def documents(spark, sf):
    members = standin.members(spark, sf, questions=DOCUMENTS, origins=False)
    return demographics.documents(members).select("_index", "R03", "doc5plus", "doc04", "documents")


@query
def labour_force(spark, sf):
    linked = respondents(spark, sf)
    out = indicators.labour_force(indicators.working_age(linked, PROFILE))
    return out.select("_index", "workingAge", "employed", "unemployed", "labourForce", "employmentStatus")


def _forms_query(name: str, step: Callable[[DataFrame], DataFrame], *columns: str) -> None:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return step(standin.households(spark, sf, respondent=False)).select("_index", *columns)
    run.__name__ = name
    query(run)


_forms_query("banking", indicators.banking, "banking")
_forms_query("health_access", indicators.health_access, "healthaccess")
_forms_query("cooking_fuel", indicators.cooking_fuel, "cookingfuel")
_forms_query("safety", indicators.safety, "SAF01SDG")
_forms_query("drinking_water", indicators.drinking_water,
             "improvedDrinkingWater", "DWA03", "basicDrinkingWater")
_forms_query("sanitation", indicators.sanitation, "improvedSanitation", "basicSanitation")
_forms_query("electricity", indicators.electricity, "electricity")
_forms_query("basic_facilities", indicators.household_services, "basicFacilities")


# --- margins -----------------------------------------------------------------

@query
def margin_consistency(spark, sf):
    dem = margins.check_cells(margins.in_scope(standin.population(spark, sf), PROFILE))
    return dem.select("origin_iso3", "checkFemale", "checkMale", "checkTotalEndYear",
                      "checkFemaleDiff", "checkMaleDiff", "checkTotalEndYearDiff")


@query
def margin_by_origin(spark, sf):
    return origins(spark, sf).orderBy(F.col("totalEndYear").desc_nulls_last(), "origin_iso3")


@query
def margin_adults_by_origin(spark, sf):
    dem = margins.in_scope(standin.population(spark, sf), PROFILE)
    return margins.cells_by_origin(dem, PROFILE, margins.ADULT_CELLS).orderBy(F.col("totalEndYear").desc(), "origin_iso3")


@query
def margin_adult_shares(spark, sf):
    out = margins.adult_counts(origins(spark, sf))
    return rounded(out, 9, "percFemale", "percMale")


@query
def margin_member_shares(spark, sf):
    out = margins.member_counts(origins(spark, sf)).drop(*margins.CELLS)
    return rounded(out, 9, *[c for c in out.columns if c.startswith("perc")]).orderBy(F.col("n").desc(), "origin_iso3")


@query
def margin_adult(spark, sf):
    return margins.adult_margin(origins(spark, sf), PROFILE)


@query
def margin_member(spark, sf):
    return margins.member_margin(origins(spark, sf), PROFILE)


@query
def population_distribution(spark, sf):
    shares = rounded(margins.origin_shares(origins(spark, sf)), 9, "perc")
    return shares.orderBy(F.col("n").desc(), "origin_iso3")


@query
def respondent_origin_shares(spark, sf):
    """Foreign respondents by origin with their shares."""
    hh = households_clean(spark, sf).select("origin").filter(F.col("origin") != PROFILE.host)
    return rounded(quality.distribution(hh, "origin"), 9, "perc").orderBy(F.col("n").desc(), "origin")


@query
def adult_sample_by_stratum(spark, sf):
    """Foreign respondents by post-stratum."""
    hh = households_clean(spark, sf, "skip").select("_index", "origin", "R02")
    rows = weight.adult_rows(hh, standin.countries(spark, sf), PROFILE)
    return quality.frequency(rows, "originSex_ps").orderBy(F.col("n").desc(), "originSex_ps")


@query
def eligible_age_range(spark, sf):
    """Youngest and oldest respondent."""
    linked = respondents(spark, sf)
    return linked.agg(F.min("R03").alias("youngest"), F.max("R03").alias("oldest"))


@query
def origin_sex_wide(spark, sf):
    hh = households_clean(spark, sf)
    return margins.respondents_by_citizenship(hh, PROFILE).orderBy(F.col("total").desc(), "citizenship")


@query
def sex_share_within_origin(spark, sf):
    out = margins.respondents_by_origin_sex(households_clean(spark, sf), PROFILE)
    return rounded(out, 9, "percFemale", "percMale").orderBy(F.col("n").desc(), "origin")


@query
def age_share_within_origin(spark, sf):
    members = demographics.age_group(member_origin(spark, sf))
    counted = members.groupBy("citizenship", "R03bin").agg(F.count(F.lit(1)).alias("n"))
    return rounded(quality.share_within(counted, "n", ["citizenship"], "share"), 9, "share")


@query
def origin_distribution(spark, sf):
    base, members = base_and_members(spark, sf)
    base = stage(base.drop(*HOUSEHOLD_IDENTIFIERS), "households")
    hh = clean.enrich_households(base, members, PROFILE)
    s1 = clean.enrich_members(members, base, PROFILE)
    tables = [
        quality.distribution(df, column).select(
            F.lit(source).alias("source"), F.col(column).cast("string").alias("value"), "n",
            F.round("perc", 9).alias("perc"))
        for source, df, column in (
            ("respondents", hh, "origin"), ("members", s1, "origin"), ("households", base, "allNationals"))
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2]).orderBy("source", F.col("n").desc(), "value")


# --- tables and checks -------------------------------------------------------

@query
def freq_table(spark, sf):
    members = standin.members(spark, sf, questions=(), origins=False)
    return quality.frequency(members, "R02_rel")


@query
def crosstab(spark, sf):
    linked = respondents(spark, sf)
    out = indicators.labour_force(indicators.working_age(linked, PROFILE))
    return quality.crosstab(out, "labourForce", "employed")


@query
def labour_crosstabs(spark, sf):
    """Labour force by unemployed, and employed by unemployed, in one long table."""
    linked = respondents(spark, sf)
    out = indicators.labour_force(indicators.working_age(linked, PROFILE))
    pairs = (("labourForce", "unemployed"), ("employed", "unemployed"))
    tables = [quality.crosstab(out, a, b).select(
        F.lit(f"{a} x {b}").alias("table"), F.col(a).cast("int").alias("a"), F.col(b).cast("int").alias("b"), "n")
        for a, b in pairs]
    return tables[0].unionByName(tables[1]).orderBy("table", "a", "b")


@query
def prop_table(spark, sf):
    out = quality.proportions(indicators.safety(standin.households(spark, sf, respondent=False)), "SAF01SDG")
    return rounded(out, 9, "perc")


@query
def duplicate_keys(spark, sf):
    part_a, part_b = two_roster_parts(spark, sf)
    checks = [
        ("indid2 in part A", part_a, ["_parent_index", "R01", "R03"]),
        ("indid2 in part B", part_b, ["_parent_index", "name_individual", "ind_age_year"]),
        ("household and age", part_a, ["_parent_index", "R03"]),
    ]
    out = [quality.duplicate_keys(df, keys).select(F.lit(name).alias("check"), "*")
           for name, df, keys in checks]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query
def column_summary(spark, sf):
    members = standin.members(spark, sf, questions=(), origins=False)
    water = indicators.drinking_water(standin.households(spark, sf, respondent=False))
    return rounded(
        quality.column_summary(members, ["R03", "member_no"]).unionByName(
            quality.column_summary(water, ["DWA03"])), 9, "mean")


@query
def quantity_summary(spark, sf):
    """Five-number summary of amounts, of which nearly every one is a value of its own."""
    amounts = standin.table(spark, sf, "lineitem").select("l_extendedprice", "l_quantity")
    orders = standin.table(spark, sf, "orders").select("o_totalprice")
    return rounded(quality.column_summary(amounts, ["l_extendedprice", "l_quantity"]).unionByName(
        quality.column_summary(orders, ["o_totalprice"])), 6, "mean", "q1", "median", "q3")


@query
def table_with_shared_levels(spark, sf):
    """Documents by disability and by age known, two breakdowns that both have a level "Unknown"."""
    design = member_design_ps(spark, sf, *MEMBER_COLUMNS)
    known = F.when(F.col("R03cat").isin("0-4", "5-11", "12-17"), "Child").when(
        F.col("R03cat") == "60+", "Unknown").otherwise("Adult")
    design = design.with_columns({"ageKnown": known})
    by = [Breakdown("DISABILITY3", (*report.DISABILITY_LEVELS, "Unknown")),
          Breakdown("ageKnown", ("Child", "Adult", "Unknown"))]
    table = report.indicator_table(design, "documents", by, "Core outcome 1.3", "Household member")
    shown = table.select("row_no", "Answers", "n", "Total", "Child", "Adult", F.col("Unknown (ageKnown)").alias("unknown_age"),
                         F.col("Unknown (DISABILITY3)").alias("unknown_disability"))
    return rounded(shown.filter(F.col("row_no") < report.BASE_ROW), 4, "n").transform(
        lambda df: rounded(df, 6, "Total", "Child", "Adult", "unknown_age", "unknown_disability"))


@query
def join_fanout(spark, sf):
    members = standin.members(spark, sf, questions=(), origins=False)
    return linkage.fan_out(members, ["_parent_index", "R02", "R03"])


@query
def poststratum_keys(spark, sf):
    s1 = members_with_origin(spark, sf)
    rows = weight.member_rows(s1, standin.countries(spark, sf), PROFILE, missing_age="leave_out")
    keyed = demographics.adult_stratum(rows)
    return keyed.select("_index", "origin_ps", "R03bin", "originSex_ps", "originAgeSex_ps")


@query
def members_left_out(spark, sf):
    """Foreign members without an age, which no post-stratum takes, by origin."""
    gaps = weight.foreign_without_age(members_with_origin(spark, sf), PROFILE)
    return gaps.groupBy("origin").agg(F.count(F.lit(1)).alias("n"))


@query
def sample_by_stratum(spark, sf):
    s1 = members_with_origin(spark, sf)
    located = linkage.add_region(s1, standin.countries(spark, sf), "origin")
    binned = demographics.age_group(demographics.collapse_origin(located, PROFILE))
    keyed = demographics.member_stratum(binned)
    kept = household.not_host_or_blank(keyed, PROFILE)
    return quality.frequency(kept, "originAgeSex_ps").orderBy(F.col("n").desc(), "originAgeSex_ps")


# --- designs and estimates ---------------------------------------------------

@query
def adult_design_weights(spark, sf):
    design, _ = adult_design_base(spark, sf)
    return rounded(design.df.select(
        "_index", "hhadults", "selectionprob", "dweightAdultInd", "fpcAdultInd"),
        9, "selectionprob", "dweightAdultInd")


@query
def member_design_weights(spark, sf):
    design, _ = member_design_base(spark, sf)
    return rounded(design.df.select("_index", "dweightHHM", "fpcHHM"), 9, "dweightHHM", "fpcHHM")


@query
def poststratified_weights(spark, sf):
    design = member_design_ps(spark, sf)
    return rounded(design.df.select("_index", "originAgeSex_ps", "weight_ps"), 6, "weight_ps")


@query
def poststratified_adult_weights(spark, sf):
    design = adult_design_ps(spark, sf)
    return rounded(design.df.select("_index", "originSex_ps", "weight_ps"), 6, "weight_ps")


@query
def calibration_check(spark, sf):
    design, margin = member_design_base(spark, sf)
    out = calibration(poststratify(design, "originAgeSex_ps", margin), margin)
    return rounded(out, 4, "weighted")


@query
def adult_calibration_check(spark, sf):
    design, margin = adult_design_base(spark, sf)
    out = calibration(poststratify(design, "originSex_ps", margin), margin)
    return rounded(out, 4, "weighted")


def _cells(df: DataFrame, *extra: str) -> DataFrame:
    digits = {"n": 4, "p": 6, "se": 6, "low": 6, "upp": 6}
    shown = ["breakdown", "level", "answer", "n", "unwn", *extra]
    return df.select(*[
        F.round(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in shown])


@query
def weighted_total_se(spark, sf):
    design = member_design_ps(spark, sf, *MEMBER_COLUMNS)
    cells = estimate(design, "documents", report.PERSON_BREAKDOWNS, stat="total")
    return rounded(cells.select("breakdown", "level", "answer", "n", "unwn", "se"), 4, "n", "se")


@query
def design_totals(spark, sf):
    tables = base_and_members(spark, sf, "skip")
    adult, _ = adult_design_base(spark, sf, tables)
    member, _ = member_design_base(spark, sf, members=tables[1])
    out = design_total(adult).withColumn("design", F.lit("adults")).unionByName(
        design_total(member).withColumn("design", F.lit("members")))
    return rounded(out, 4, "n", "se")


@query
def weighted_proportion_se(spark, sf):
    design, _ = member_design_base(spark, sf, "DISABILITY3")
    cells = estimate(design, "DISABILITY3", report.PERSON_BREAKDOWNS[:1])
    return _cells(cells, "p", "se")


@query
def adult_proportion_se(spark, sf):
    design, _ = adult_design_base(spark, sf)
    return _cells(estimate(design, "R03cat2"), "p", "se")


@query
def weighted_proportion_ci(spark, sf):
    design = member_design_ps(spark, sf, *MEMBER_COLUMNS)
    cells = with_limits(estimate(design, "documents", report.PERSON_BREAKDOWNS))
    return _cells(cells, "p", "se", "df", "low", "upp")


@query
def adult_proportion_ci(spark, sf):
    cells = with_limits(estimate(adult_design_ps(spark, sf), "SAF01SDG", report.PERSON_BREAKDOWNS))
    return _cells(cells, "p", "se", "df", "low", "upp")


@query
def domain_unemployment(spark, sf):
    design = adult_design_ps(spark, sf).filter("labourForce = 'In the labour force'")
    cells = with_limits(estimate(design, "employmentStatus", report.PERSON_BREAKDOWNS))
    return _cells(cells, "p", "se", "df", "low", "upp")


def _beside_unweighted(design: SurveyDesign, x: str) -> DataFrame:
    cells = estimate(design, x).select("answer", "p", "se", "unwn")
    plain = quality.proportions(design.df, x).select(
        F.col(x).cast("string").alias("answer"), F.col("perc").alias("p_unweighted"))
    out = cells.join(plain, "answer", "left").withColumn("question", F.lit(x))
    return rounded(out, 6, "p", "se", "p_unweighted")


@query
def weighted_vs_unweighted(spark, sf):
    tables = base_and_members(spark, sf, "skip")
    adult = _beside_unweighted(adult_design_ps(spark, sf, tables), "SAF01SDG")
    member = member_design_ps(spark, sf, "documents", members=tables[1])
    return adult.unionByName(_beside_unweighted(member, "documents"))


@query
def equal_probability_table(spark, sf):
    hh = households_clean(spark, sf, "skip")
    design = equal_probability(stage(decode(hh.select("_index", *HOUSEHOLD_COLUMNS)), "households"))
    cells = with_limits(estimate(design, "hhsizecat", report.HOUSEHOLD_BREAKDOWNS))
    return _cells(cells, "p", "se", "df", "low", "upp")


@query
def equal_probability_members(spark, sf):
    members = standin.members(spark, sf, questions=[*FUNCTIONING, *DOCUMENTS], origins=False)
    out = demographics.documents(demographics.disability(demographics.age_bands(members)))
    kept = decode(out.select("_parent_index", "R02", "R03cat", "DISABILITY3", "documents"))
    design = equal_probability(stage(kept, "members"), psu="_parent_index")
    cells = with_limits(estimate(design, "documents", report.PERSON_BREAKDOWNS))
    return _cells(cells, "p", "se", "df", "low", "upp")


@query
def foreign_households_table(spark, sf):
    hh = households_clean(spark, sf, "skip").filter(F.col("allNationals") == 0)
    design = equal_probability(stage(decode(hh.select("_index", *HOUSEHOLD_COLUMNS)), "households"))
    return _cells(with_limits(estimate(design, "electricity")), "p", "se", "df", "low", "upp")


@query
def income_change_table(spark, sf):
    design = adult_design_ps(spark, sf).with_columns({"R02x": F.col("R02")})
    by = [Breakdown("R02x", report.SEX_LEVELS)]
    return _cells(with_limits(estimate(design, "INC01", by)), "p", "se", "df", "low", "upp")


# --- report ------------------------------------------------------------------

def _report_rounded(df: DataFrame, *keys: str) -> DataFrame:
    fixed = {*keys, *report.HEADER, "Answers"}
    base_row = F.col("row_no") > report.BASE_ROW

    def short(c: str) -> Column:
        value = F.col(f"`{c}`")
        if c == "n":
            return F.round(value, 4).alias(c)
        return F.when(base_row, F.round(value, 4)).otherwise(F.round(value, 6)).alias(c)

    return df.select(*[F.col(f"`{c}`") if c in fixed else short(c) for c in df.columns])


@query
def indicator_table_wide(spark, sf):
    table = report.indicator_table(
        member_design_ps(spark, sf, *MEMBER_COLUMNS), "documents", report.PERSON_BREAKDOWNS,
        "Core outcome 1.3", "Household member")
    return _report_rounded(table, "row_no")


@query
def report_join_form(spark, sf):
    table = report.joined_table(
        member_design_ps(spark, sf, *MEMBER_COLUMNS), "documents", report.PERSON_BREAKDOWNS,
        "Core outcome 1.3", "Household member")
    return _report_rounded(table, "row_no")


def report_designs(spark: SparkSession, sf: str) -> weight.Designs:
    """Clean tables and designs of the stand-in survey.

    A missing age elsewhere in the household must not cost the respondent's
    weight, hence ``missing="skip"``.
    """
    items = standin.roster(spark, sf)
    used = ["_parent_index", "origin", "R03", "hhadults", "allNationals", *report.REPORT_COLUMNS]
    tables = clean.clean(
        standin.households(spark, sf, items=items), standin.members(spark, sf, items=items), PROFILE, missing="skip",
        keep_answers=False, columns=used)
    return weight.build_designs(
        stage(tables.hh, "hh"), tables.s1, standin.population(spark, sf), standin.countries(spark, sf), PROFILE,
        columns=report.REPORT_COLUMNS, missing_age="leave_out")


@query
def report_combined(spark, sf):
    return _report_rounded(report.full_report(report_designs(spark, sf)), "table_no", "row_no")
