"""SQL that must give the same rows as the named queries."""

from __future__ import annotations

from surveyspark.catalog import oracle_estimates as oe
from surveyspark.catalog.views import BROAD, FINE, text_of, with_views
from surveyspark.operators import demographics as dm
from surveyspark.operators import indicators as ind
from surveyspark.plans import report
from surveyspark.sources.standin import INCOME_LABELS

ORACLE: dict[str, str] = {}


def texts(column: str, labels: dict) -> str:
    return text_of(column, {str(k): v.replace("'", "''") for k, v in labels.items()})


def add(name: str, body: str, extra: dict[str, str] | None = None) -> None:
    ORACLE[name] = with_views(body, extra)


# --- households and links ----------------------------------------------------

add("head_of_household", "SELECT _parent_index, _index, householdHead FROM s1_head")
add("household_rollup", """
SELECT _parent_index, hhsize, hhNationals, hhadults, hhdisability3, hhsizecat, allNationals FROM rolled""")
_HEAD = """_index AS headHHindex, R02 AS headHHR02, R03 AS headHHR03, R03cat AS headHHR03cat, R03cat2 AS headHHR03cat2,
  citizenship AS headHHcitizenship, REF06 AS headHHREF06"""
add("head_attributes", f"""
SELECT r._parent_index, h.* EXCLUDE (hh) FROM rolled r LEFT JOIN (
  SELECT _parent_index AS hh, {_HEAD} FROM s1_head WHERE householdHead = 1) h ON r._parent_index = h.hh""")
add("household_origin_by_count", "SELECT * FROM hh_origin")
add("household_origin_by_value", """
SELECT _parent_index, originAux AS originAux2 FROM origin_ranked WHERE by_value = 1""")
add("origin_imputation", "SELECT _index, citizenship, originAux, originAux2, origin FROM s1_origin")
add("age_bands", "SELECT _index, R03, R03cat, R03cat2 FROM s1_demo")
_FLAGS = ", ".join(
    f"coalesce(DIS0{i} IN ({codes}), false) AS disaux{i}_{k}"
    for i in range(1, 7) for k, codes in (("234", "'2','3','4'"), ("34", "'3','4'")))
add("disability_identifiers", f"""
SELECT _index, {_FLAGS}, disSum234, disSum34, DISABILITY1, DISABILITY2, DISABILITY3, DISABILITY4
FROM s1_demo""")
add("region_lookup", """
SELECT citizenship, coalesce(hcr_region, 'Unknown') AS originHcrRegion, count(*) AS n
FROM s1_demo LEFT JOIN countries ON citizenship = iso3 GROUP BY 1, 2""")
add("roster_merge", """
SELECT a._index, a._parent_index, a.member_no, a.R01, a.R02, a.R03,
  b.R01 AS name_individual, b.R03 AS ind_age_year, b.R02_rel, b.DIS01,
  a._parent_index || '_' || a.R01 || '_' || coalesce(cast(a.R03 AS varchar), 'NA') AS indid2
FROM s1_raw a LEFT JOIN s1_raw b
  ON a._parent_index || '_' || a.R01 || '_' || coalesce(cast(a.R03 AS varchar), 'NA')
   = b._parent_index || '_' || b.R01 || '_' || coalesce(cast(b.R03 AS varchar), 'NA')""")
add("respondent_attributes", """
SELECT h._index, cast(selected_adult AS int) AS selected_adult, R02, R02_rel, R03,
  h._index || '_' || coalesce(selected_adult, 'NA') AS indid
FROM hh_raw h LEFT JOIN s1_keys s
  ON s._parent_index = h._index AND s.member_no = cast(selected_adult AS int)""")
add("household_enriched", f"""
SELECT h._index, hhsize, hhadults, hhdisability3, hhsizecat, allNationals,
  headHHR02, headHHR03, headHHR03cat, headHHcitizenship, originAux2,
  R02, R03, citizenship, documents, DISABILITY3, origin,
  workingAge, labourForce, employmentStatus, basicFacilities
FROM hh_clean h LEFT JOIN (SELECT _parent_index AS hh, {_HEAD} FROM s1_head WHERE householdHead = 1) x
  ON h._index = x.hh""")
add("member_enriched", """
SELECT s._index, s._parent_index, householdHead, cookingfuel, electricity, basicSanitation,
  basicDrinkingWater, basicFacilities, originAux2, hhadults, origin
FROM s1_origin s JOIN s1_head h ON s._index = h._index""")
add("join_checks", """
SELECT 'households' AS measure, count(*) AS n FROM orders
UNION ALL SELECT 'households_after', count(*) FROM orders
UNION ALL SELECT 'without_members', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT 'members', count(*) FROM lineitem
UNION ALL SELECT 'without_key', count(*) FROM lineitem WHERE l_orderkey IS NULL
UNION ALL SELECT 'linked', count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
add("saved_tables", f"""
SELECT {texts('R03cat', {i: t for i, t in enumerate(FINE, start=1)})} AS R03cat, count(*) AS n,
  cast(sum({" + ".join(f"coalesce(DIS0{i} IN ('98', '99'), false)::int" for i in range(1, 7))}) AS bigint) AS refusals
FROM s1_demo GROUP BY 1""")
add("households_from_submissions", f"""
SELECT h._index, hhsize, hhadults, hhdisability3, hhsizecat, allNationals,
  headHHR02, headHHR03, headHHR03cat, headHHcitizenship,
  R02, R03, citizenship, documents, DISABILITY3, origin,
  workingAge, labourForce, employmentStatus, basicFacilities
FROM hh_clean h LEFT JOIN (SELECT _parent_index AS hh, {_HEAD} FROM s1_head WHERE householdHead = 1) x
  ON h._index = x.hh""")
add("members_from_submissions", """
SELECT s._parent_index, s.member_no, householdHead, cookingfuel, electricity, basicSanitation,
  basicDrinkingWater, basicFacilities, hhadults, origin
FROM s1_origin s JOIN s1_head h ON s._index = h._index""")
add("natural_join", """
SELECT _index, _parent_index, R03, CASE WHEN age_rank = 1 THEN 1 END AS oldestHHM FROM head_counts""")
add("checked_join", """
SELECT l_orderkey * 1000000000 + member_no AS _index, l_orderkey AS _parent_index,
  count(*) OVER (PARTITION BY l_orderkey) AS hhsize FROM items""")
add("deidentified", """
SELECT * EXCLUDE (adult_name, fam_name1, selected_adult), cast(selected_adult AS int) AS selected_adult
FROM hh_raw""")
add("deidentified_members", """
SELECT _index, _parent_index, member_no, R02, R03, R02_rel, REF01, REF02, REF06,
  DIS01, DIS02, DIS03, DIS04, DIS05, DIS06 FROM s1_raw""")
_BANDS = {i: t for i, t in enumerate(FINE, start=1)}
_BROAD = {i: t for i, t in enumerate(BROAD, start=1)}
_NONE = "CASE {0} WHEN '77' THEN 'Stateless' WHEN '98' THEN 'Don''t know' WHEN '99' THEN 'No answer' ELSE {0} END"
add("decoded_labels", f"""
SELECT _index, {texts('R03cat', _BANDS)} AS R03cat, {texts('R03cat2', _BROAD)} AS R03cat2,
  {texts('DISABILITY1', dm.DISABILITY_LABELS)} AS DISABILITY1,
  {texts('DISABILITY4', dm.DISABILITY_LABELS)} AS DISABILITY4,
  {texts('documents', dm.DOCUMENT_LABELS)} AS documents,
  coalesce(c.name, {_NONE.format('citizenship')}) AS citizenship, coalesce(o.name, {_NONE.format('origin')}) AS origin
FROM s1_origin LEFT JOIN countries c ON citizenship = c.iso3 LEFT JOIN countries o ON origin = o.iso3""")
add("submissions_flatten", """
SELECT l_orderkey * 1000000000 + member_no AS _index, l_orderkey AS _parent_index,
  cast(member_no AS int) AS member_no, cast(l_linenumber AS varchar) AS R02_rel, cast(l_quantity AS int) AS R03
FROM items""")

# --- indicators --------------------------------------------------------------

add("documents", "SELECT _index, R03, doc5plus, doc04, documents FROM s1_demo")
add("labour_force", """
SELECT _index, workingAge, CASE WHEN outcome = 'paid' THEN 1 WHEN employmentStatus = 1 THEN 0 END AS employed,
  employmentStatus AS unemployed, labourForce, employmentStatus FROM hh_clean""")
for _name, _columns in {
    "banking": "banking", "health_access": "healthaccess", "cooking_fuel": "cookingfuel",
    "safety": "SAF01SDG", "drinking_water": "improvedDrinkingWater, DWA03, basicDrinkingWater",
    "sanitation": "improvedSanitation, basicSanitation", "electricity": "electricity",
    "basic_facilities": "basicFacilities",
}.items():
    add(_name, f"SELECT _index, {_columns} FROM hh_ind")

# --- margins -----------------------------------------------------------------

add("margin_consistency", """
SELECT origin_iso3, checkFemale, checkMale, checkFemale + checkMale AS checkTotalEndYear,
  checkFemale - female AS checkFemaleDiff, checkMale - male AS checkMaleDiff,
  checkFemale + checkMale - (female + male) AS checkTotalEndYearDiff
FROM (SELECT CASE origin_iso3 WHEN '98' THEN 'UKN' ELSE origin_iso3 END AS origin_iso3,
    cast(coalesce(sum(n) FILTER (pos < 5), 0) AS bigint) AS checkFemale,
    cast(coalesce(sum(n) FILTER (pos >= 5), 0) AS bigint) AS checkMale,
    cast(coalesce(sum(n) FILTER (pos < 5), 0) + any_value(n_nationkey) % 3 AS bigint) AS female,
    cast(coalesce(sum(n) FILTER (pos >= 5), 0) + any_value(n_nationkey) % 2 AS bigint) AS male
  FROM dem_cells GROUP BY origin_iso3)""")
add("respondent_origin_shares", """
SELECT origin, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS perc
FROM hh_clean WHERE origin <> 'NATION_8' GROUP BY origin""")
add("adult_sample_by_stratum", "SELECT originSex_ps, count(*) AS n FROM hh_strata GROUP BY originSex_ps")
add("eligible_age_range", "SELECT min(R03) AS youngest, max(R03) AS oldest FROM hh_linked")
add("labour_crosstabs", """
SELECT 'labourForce x unemployed' AS "table", labourForce AS a, employmentStatus AS b, count(*) AS n
FROM hh_clean GROUP BY 2, 3
UNION ALL
SELECT 'employed x unemployed', CASE WHEN outcome = 'paid' THEN 1 WHEN employmentStatus = 1 THEN 0 END,
  employmentStatus, count(*) FROM hh_clean GROUP BY 2, 3""")
add("margin_by_origin", "SELECT * FROM origins")
add("margin_adults_by_origin", """
SELECT origin_iso3, female_18_59, female_60, male_18_59, male_60,
  female_18_59 + female_60 + male_18_59 + male_60 AS totalEndYear FROM origins""")
add("margin_adult_shares", """
SELECT *, Female + Male AS n, round(Female / (Female + Male), 9) AS percFemale,
  round(Male / (Female + Male), 9) AS percMale
FROM (SELECT origin_iso3, originHcrRegion, female_18_59, female_60, male_18_59, male_60,
  female_18_59 + female_60 AS Female, male_18_59 + male_60 AS Male FROM origins)""")
add("margin_member_shares", """
SELECT *, round(Child_Female / n, 9) AS percChild_Female, round(Child_Male / n, 9) AS percChild_Male,
  round(Adult_Female / n, 9) AS percAdult_Female, round(Adult_Male / n, 9) AS percAdult_Male
FROM (SELECT origin_iso3, originHcrRegion, female_0_4 + female_5_11 + female_12_17 AS Child_Female,
  male_0_4 + male_5_11 + male_12_17 AS Child_Male, female_18_59 + female_60 AS Adult_Female,
  male_18_59 + male_60 AS Adult_Male, totalEndYear AS n FROM origins)""")
add("margin_adult", "SELECT * FROM margin_adult")
add("margin_member", "SELECT * FROM margin_member")
add("population_distribution", """
SELECT origin_iso3, totalEndYear AS n,
  round(totalEndYear / (SELECT sum(totalEndYear) FROM origins), 9) AS perc FROM origins""")
_WIDE = ", ".join(
    f"nullif(count(*) FILTER (R02 = '{s}' AND R03cat2 = {c}), 0) AS \"{s}_{t}\""
    for s in ("Female", "Male") for c, t in ((4, "18-59"), (5, "60+")))
add("origin_sex_wide", f"""
SELECT citizenship, {_WIDE}, count(*) FILTER (R03cat2 >= 4) AS total
FROM hh_clean WHERE citizenship <> 'NATION_8' GROUP BY citizenship""")
add("sex_share_within_origin", """
SELECT *, round(Female / n, 9) AS percFemale, round(Male / n, 9) AS percMale
FROM (SELECT origin, nullif(count(*) FILTER (R02 = 'Female'), 0) AS Female,
  nullif(count(*) FILTER (R02 = 'Male'), 0) AS Male, count(*) AS n
  FROM hh_clean WHERE origin <> 'NATION_8' GROUP BY origin)""")
add("age_share_within_origin", """
SELECT citizenship, R03bin, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (PARTITION BY citizenship), 9) AS share
FROM (SELECT citizenship, CASE WHEN R03 < 18 THEN 'Child' WHEN R03 >= 18 THEN 'Adult' END AS R03bin
  FROM s1_demo) GROUP BY citizenship, R03bin""")
add("origin_distribution", """
SELECT 'respondents' AS source, origin AS value, count(*) AS n,
  round(count(*) / sum(count(*)) OVER (), 9) AS perc FROM hh_clean GROUP BY origin
UNION ALL SELECT 'members', origin, count(*), round(count(*) / sum(count(*)) OVER (), 9)
FROM s1_origin GROUP BY origin
UNION ALL SELECT 'households', cast(allNationals AS varchar), count(*),
  round(count(*) / sum(count(*)) OVER (), 9) FROM hh_base GROUP BY allNationals""")

# --- tables and checks -------------------------------------------------------

add("freq_table", "SELECT R02_rel, count(*) AS n FROM s1_keys GROUP BY R02_rel")
add("crosstab", """
SELECT labourForce, CASE WHEN outcome = 'paid' THEN 1 WHEN employmentStatus = 1 THEN 0 END AS employed,
  count(*) AS n FROM hh_clean GROUP BY 1, 2""")
add("prop_table", """
SELECT SAF01SDG, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 9) AS perc
FROM hh_ind WHERE SAF01SDG IS NOT NULL GROUP BY SAF01SDG""")
_DUP = """SELECT '{0}' AS "check", cast(sum(n) AS bigint) AS n_rows, count(*) AS n_keys,
  cast(sum(n - 1) AS bigint) AS n_duplicated FROM (SELECT count(*) AS n FROM s1_keys GROUP BY {1})"""
add("duplicate_keys", " UNION ALL ".join([
    _DUP.format("indid2 in part A", "_parent_index, R01, R03"),
    _DUP.format("indid2 in part B", "_parent_index, R01, R03"),
    _DUP.format("household and age", "_parent_index, R03")]))
_SUMMARY = """SELECT '{0}' AS variable, count(*) AS n_rows, count(*) - count({0}) AS n_missing,
  min({0})::double AS min, quantile_cont({0}::double, 0.25) AS q1, quantile_cont({0}::double, 0.5) AS median,
  quantile_cont({0}::double, 0.75) AS q3, max({0})::double AS max, round(avg({0}), 9) AS mean FROM {1}"""
add("column_summary", " UNION ALL ".join([
    _SUMMARY.format("R03", "s1_keys"), _SUMMARY.format("member_no", "s1_keys"),
    _SUMMARY.format("DWA03", "hh_ind")]))
_AMOUNTS = """SELECT '{0}' AS variable, count(*) AS n_rows, count(*) - count({0}) AS n_missing, min({0})::double AS min,
  round(quantile_cont({0}::double, 0.25), 6) AS q1, round(quantile_cont({0}::double, 0.5), 6) AS median,
  round(quantile_cont({0}::double, 0.75), 6) AS q3, max({0})::double AS max, round(avg({0}::double), 6) AS mean FROM {1}"""
add("quantity_summary", " UNION ALL ".join([
    _AMOUNTS.format("l_extendedprice", "lineitem"), _AMOUNTS.format("l_quantity", "lineitem"),
    _AMOUNTS.format("o_totalprice", "orders")]))
_SHARED = ", ".join(
    f"round(sum(w) FILTER ({hit}) / any_value({name}_all), 6) AS {column}" for hit, name, column in (
        ("true", "t", '"Total"'), ("age = 'Child'", "c", '"Child"'), ("age = 'Adult'", "a", '"Adult"'),
        ("age = 'Unknown'", "u", "unknown_age"), ("DISABILITY3 = 98", "d", "unknown_disability")))
add("table_with_shared_levels", f"""
SELECT documents + 1 AS row_no, {texts('documents', dm.DOCUMENT_LABELS)} AS "Answers", round(sum(w), 4) AS n, {_SHARED}
FROM (SELECT *, sum(w) OVER () AS t_all, sum(w) FILTER (age = 'Child') OVER () AS c_all,
    sum(w) FILTER (age = 'Adult') OVER () AS a_all, sum(w) FILTER (age = 'Unknown') OVER () AS u_all,
    sum(w) FILTER (DISABILITY3 = 98) OVER () AS d_all
  FROM (SELECT documents, weight_ps AS w, DISABILITY3,
      CASE WHEN R03 < 18 THEN 'Child' WHEN R03 >= 60 THEN 'Unknown' ELSE 'Adult' END AS age
    FROM member_ps WHERE documents IS NOT NULL))
GROUP BY documents""")
add("join_fanout", """
SELECT _parent_index, R02, R03, count(*) AS n FROM s1_keys
GROUP BY _parent_index, R02, R03 HAVING count(*) > 1""")
add("poststratum_keys", """
SELECT _index, origin_ps, R03bin, origin_ps || '_' || R02 AS originSex_ps, originAgeSex_ps FROM s1_strata""")
add("members_left_out", """
SELECT origin, count(*) AS n FROM s1_origin WHERE R03 IS NULL AND origin <> 'NATION_8' GROUP BY origin""")
add("sample_by_stratum", """
SELECT originAgeSex_ps, count(*) AS n FROM (
  SELECT CASE WHEN origin IS NOT NULL THEN origin_ps || '_' || CASE WHEN R03 < 18 THEN 'Child'
    WHEN R03 >= 18 THEN 'Adult' ELSE 'NA' END || '_' || R02 END AS originAgeSex_ps
  FROM (SELECT s.*, CASE WHEN origin IN ('NATION_3','NATION_12','NATION_18','NATION_21') THEN origin
      WHEN hcr_region = 'MIDDLE EAST' THEN 'OtherA' ELSE 'OtherB' END AS origin_ps
    FROM s1_origin s LEFT JOIN countries ON origin = iso3
    WHERE origin IS NULL OR origin <> 'NATION_8')) GROUP BY 1""")

# --- designs and estimates ---------------------------------------------------

add("adult_design_weights", """
SELECT _index, adults_known AS hhadults, round(1 / dweight, 9) AS selectionprob,
  round(dweight, 9) AS dweightAdultInd, (SELECT sum(Freq) FROM margin_adult)::double AS fpcAdultInd
FROM adult_base""")
add("member_design_weights", """
SELECT _index, round(dweight, 9) AS dweightHHM, round(fpc, 9) AS fpcHHM FROM member_base""")
add("poststratified_weights", """
SELECT _index, originAgeSex_ps, round(weight_ps, 6) AS weight_ps FROM member_ps""")
add("poststratified_adult_weights", """
SELECT _index, originSex_ps, round(weight_ps, 6) AS weight_ps FROM adult_ps""")
add("calibration_check", """
SELECT originAgeSex_ps, Freq, unwn, round(Freq, 4)::double AS weighted, true AS matches FROM margin_member
JOIN (SELECT originAgeSex_ps, count(*) AS unwn FROM s1_strata GROUP BY 1) USING (originAgeSex_ps)""")
add("adult_calibration_check", """
SELECT originSex_ps, Freq, unwn, round(Freq, 4)::double AS weighted, true AS matches FROM margin_adult
JOIN (SELECT originSex_ps, count(*) AS unwn FROM hh_strata GROUP BY 1) USING (originSex_ps)""")

_DOC = texts("documents", dm.DOCUMENT_LABELS)
_SAF = texts("SAF01SDG", ind.SAFETY_LABELS)
_CELL = "breakdown, level, answer, round(n, 4) AS n, unwn"
_SE = ", round(p, 6) AS p, round(se, 6) AS se"
_CI = _SE + ", df, round(low, 6) AS low, round(upp, 6) AS upp"

ORACLE["weighted_total_se"] = oe.cells_sql(
    oe.person_rows(oe.MEMBER_PS, _DOC), oe.PERSON, _CELL + ", round(se, 4) AS se", stat="total")
_ALL = "round(n, 4) AS n, unwn, round(se, 4) AS se"
# every row of an unstratified, unclustered constant: closed form of the total's error
add("design_totals", """
SELECT 'adults' AS design, round(sum(dweight), 4) AS n, count(*) AS unwn,
  round(sqrt((1 - max(fpc)) * count(*) / (count(*) - 1)
    * (sum(dweight * dweight) - sum(dweight) * sum(dweight) / count(*))), 4) AS se FROM adult_base
UNION ALL
SELECT 'members', round(sum(w), 4), cast(sum(k) AS bigint), round(sqrt((1 - max(f)) * count(*) / (count(*) - 1)
    * (sum(w * w) - sum(w) * sum(w) / count(*))), 4)
FROM (SELECT sum(dweight) AS w, count(*) AS k, max(fpc) AS f FROM member_base GROUP BY _parent_index)""")
ORACLE["weighted_proportion_se"] = oe.cells_sql(
    oe.person_rows(oe.MEMBER_BASE, oe.DIS_TEXT), oe.SEX, _CELL + _SE)
ORACLE["adult_proportion_se"] = oe.cells_sql(
    oe.person_rows(oe.ADULT_BASE, texts("R03cat2", _BROAD)), [], _CELL + _SE)
ORACLE["weighted_proportion_ci"] = oe.cells_sql(
    oe.person_rows(oe.MEMBER_PS, _DOC), oe.PERSON, _CELL + _CI)
ORACLE["adult_proportion_ci"] = oe.cells_sql(
    oe.person_rows(oe.ADULT_PS, _SAF), oe.PERSON, _CELL + _CI)
_EMP = texts("employmentStatus", ind.EMPLOYMENT_LABELS)
ORACLE["domain_unemployment"] = oe.cells_sql(
    oe.person_rows(oe.ADULT_PS, _EMP, "labourForce = 1"), oe.PERSON, _CELL + _CI)
ORACLE["design_roundtrip"] = oe.cells_sql(
    oe.person_rows(oe.ADULT_PS, _SAF, "labourForce = 1"), oe.SEX, _CELL + _SE + ", df")
_BESIDE = """SELECT answer, round(p, 6) AS p, round(se, 6) AS se, unwn,
  round(unwn / sum(unwn) OVER (PARTITION BY tab), 6) AS p_unweighted,
  CASE tab WHEN 1 THEN 'SAF01SDG' ELSE 'documents' END AS question FROM est"""
ORACLE["weighted_vs_unweighted"] = with_views(_BESIDE, oe.estimate_views(
    oe.person_rows(oe.ADULT_PS, _SAF) + "\nUNION ALL\n"
    + oe.person_rows(oe.MEMBER_PS, _DOC, tab=2), []))

# household attributes when unanswered relations, ages and citizenships are skipped
_SKIP = {
    "head_skip": f"""
SELECT _parent_index AS hh, {_HEAD} FROM (SELECT *, row_number() OVER (PARTITION BY _parent_index
  ORDER BY coalesce(R02_rel = '1', false) DESC, R03 DESC NULLS LAST, _index) AS pick FROM s1_demo)
WHERE pick = 1""",
    "hh_skip": """
SELECT h.*, x.*, (h.hhsize = coalesce(known, 0))::int AS allNationals_skip
FROM hh_clean h LEFT JOIN head_skip x ON h._index = x.hh
LEFT JOIN (SELECT _parent_index AS p, count(*) FILTER (citizenship = 'NATION_8') AS known
  FROM s1_demo GROUP BY 1) k ON h._index = k.p""",
}
_HOUSEHOLD_ROWS = f"""
SELECT {{tab}} AS tab, _index AS psu, 1.0::double AS w, NULL AS h, 0::double AS f, {{x}} AS x,
  headHHR02 AS b1, {texts('headHHR03cat', _BANDS)} AS b2,
  {texts('hhdisability3', {0: 'Without disability', 1: 'With disability'})} AS b3 FROM hh_skip"""
ORACLE["equal_probability_table"] = with_views(
    f"SELECT {_CELL + _CI} FROM lim",
    {**_SKIP, **oe.estimate_views(_HOUSEHOLD_ROWS.format(tab=1, x="hhsizecat"), oe.HOUSEHOLD)})
ORACLE["foreign_households_table"] = with_views(
    f"SELECT {_CELL + _CI} FROM lim",
    {**_SKIP, **oe.estimate_views(
        _HOUSEHOLD_ROWS.format(tab=1, x=texts("electricity", ind.ELECTRICITY_LABELS))
        + " WHERE allNationals_skip = 0", [])})
ORACLE["equal_probability_members"] = oe.cells_sql(
    oe.person_rows(("s1_demo", "1.0::double", "_parent_index", None, "0::double"), _DOC),
    oe.PERSON, _CELL + _CI)
_INC = texts("INC01", INCOME_LABELS)
ORACLE["income_change_table"] = oe.cells_sql(
    oe.person_rows(oe.ADULT_PS, _INC), [("R02x", "Female"), ("R02x", "Male")], _CELL + _CI)

# --- report ------------------------------------------------------------------

_CODES = {
    "hhsizecat": "hhsizecat", "R02": "R02", "R03cat": oe.AGE_TEXT, "DISABILITY3": oe.DIS_TEXT,
    "basicFacilities": texts("basicFacilities", ind.FACILITIES_LABELS), "documents": _DOC,
    "cookingfuel": texts("cookingfuel", ind.COOKING_LABELS),
    "healthaccess": texts("healthaccess", ind.HEALTH_LABELS), "SAF01SDG": _SAF,
    "basicDrinkingWater": texts("basicDrinkingWater", ind.WATER_LABELS),
    "basicSanitation": texts("basicSanitation", ind.SANITATION_LABELS),
    "banking": texts("banking", ind.BANKING_LABELS), "INC01": _INC,
    "labourForce": texts("labourForce", ind.LABOUR_FORCE_LABELS), "employmentStatus": _EMP,
}
_ORDER = {
    "hhsizecat": ("1", "2-3", "4-5", "6+"), "R02": (), "R03cat": FINE,
    "DISABILITY3": tuple(dm.DISABILITY_LABELS.values()),
    "basicFacilities": tuple(ind.FACILITIES_LABELS.values()),
    "documents": tuple(dm.DOCUMENT_LABELS.values()), "cookingfuel": tuple(ind.COOKING_LABELS.values()),
    "healthaccess": tuple(ind.HEALTH_LABELS.values()), "SAF01SDG": tuple(ind.SAFETY_LABELS.values()),
    "basicDrinkingWater": tuple(ind.WATER_LABELS.values()),
    "basicSanitation": tuple(ind.SANITATION_LABELS.values()),
    "banking": tuple(ind.BANKING_LABELS.values()), "INC01": tuple(INCOME_LABELS.values()),
    "labourForce": tuple(ind.LABOUR_FORCE_LABELS.values()),
    "employmentStatus": tuple(ind.EMPLOYMENT_LABELS.values()),
}
_QUESTIONS = {
    "hhsizecat": "", "R02": "", "R03cat": "Fine age brackets",
    "DISABILITY3": "Washington Group disability identifier 3",
    "basicFacilities": "Household access to basic facilities (drinking water, sanitation, clean cooking fuel, electricity)",
    "documents": "Valid identity documents or credentials",
    "cookingfuel": "Primary cooking fuel and technology",
    "healthaccess": "Received needed health services in the last 3 months",
    "SAF01SDG": "SDG 16.1.4: How safe do you feel walking alone in your area/neighbourhood after dark?",
    "basicDrinkingWater": "Main drinking water source (basic: improved source and at most 30 minute return trip)",
    "basicSanitation": "Sanitation facility  (basic: improved and not shared)",
    "banking": "Account at a bank or other financial institution or with a mobile-money-service provider",
    "INC01": "Change in income", "labourForce": "Labour force", "employmentStatus": "Employment status",
}
_DOMAINS = {"labourForce": "workingAge = 1", "employmentStatus": "labourForce = 1"}


def _values(specs: list[tuple[int, report.TableSpec]]) -> tuple[str, str]:
    def quoted(*cells: str) -> str:
        return ", ".join("'" + c.replace("'", "''") + "'" for c in cells)

    heads = ", ".join(
        f"({no}, {quoted(s.indicator, s.unit, _QUESTIONS[s.x])})" for no, s in specs)
    order = ", ".join(
        f"({no}, {quoted(a)}, {i})" for no, s in specs for i, a in enumerate(_ORDER[s.x])) \
        or "(0, '', 0)"
    return heads, order


def _documents_table() -> str:
    spec = report.TableSpec("documents", "", "Household member", "Core outcome 1.3")
    heads, order = _values([(1, spec)])
    return oe.report_sql(
        oe.person_rows(oe.MEMBER_PS, _DOC), oe.PERSON, heads, order, order_by_tab=False)


def _full_report() -> str:
    """Three blocks: the household table breaks down by other columns than the rest."""
    specs = list(enumerate(report.REPORT, start=1))
    rows = []
    for no, s in specs:
        if s.design == "households":
            rows.append(_HOUSEHOLD_ROWS.format(tab=no, x=_CODES[s.x]))
        else:
            design = oe.MEMBER_PS if s.design == "foreign_members" else oe.ADULT_PS
            rows.append(oe.person_rows(design, _CODES[s.x], _DOMAINS.get(s.x, "true"), tab=no))
    heads, order = _values(specs)
    body = oe.report_sql("\nUNION ALL\n".join(rows), oe.PERSON, heads, order, True, _SKIP)
    return body.replace("SELECT * FROM (SELECT tab, ", "SELECT * FROM (SELECT tab AS table_no, ", 1)


ORACLE["indicator_table_wide"] = _documents_table()
ORACLE["report_join_form"] = _documents_table()
ORACLE["report_combined"] = _full_report()
