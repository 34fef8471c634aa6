"""SQL views behind the oracle queries, in the dialect of DuckDB.

Written against the same parquet tables as the Spark queries, but on their own
terms: plain CASE rules, ranked windows and row-by-cell variances.
"""

from __future__ import annotations

import re

from surveyspark.sources.standin import HOUSEHOLD_ANSWERS, MEMBER_ANSWERS


def _answer(key: str, salt: int, codes: str, name: str) -> str:
    size = len(codes.split(","))
    mixed = f"((({key}) % 1000003) * 1000 + {salt}) * 2654435761 % 4294967296"
    place = f"cast(cast(floor(({mixed}) / 65536) as bigint) % {size} + 1 as int)"
    return f"nullif(split_part('{codes}', ',', {place}), '') AS {name}"


_HH_ANSWERS = ",\n  ".join(
    _answer("o_orderkey", i, c, n) for i, (n, c) in enumerate(HOUSEHOLD_ANSWERS.items(), start=1))
_S1_GIVEN = ",\n  ".join(
    _answer("_index", i, c, n) for i, (n, c) in enumerate(MEMBER_ANSWERS.items(), start=101))

_DIS = [f"DIS0{i}" for i in range(1, 7)]
_SOME = " + ".join(f"coalesce({d} IN ('2','3','4'), false)::int" for d in _DIS)
_SEVERE = " + ".join(f"coalesce({d} IN ('3','4'), false)::int" for d in _DIS)
_REFUSED = " AND ".join(f"coalesce({d} IN ('98','99'), false)" for d in _DIS)
_UNABLE = " OR ".join(f"{d} = '4'" for d in _DIS)
# The document questions, from age 5 on and below.
_DOC5 = " OR ".join(f"{q} = '1'" for q in (
    "REG01a", "REG01b", "REG01d", "REG01e", "REG01f", "REG01h", "REG01i"))
_DOC04 = " OR ".join(f"{q} = '1'" for q in ("REG04a", "REG04c", "REG04e", "REG04f", "REG04g"))

FINE = ["0-4", "5-11", "12-17", "18-24", "25-49", "50-59", "60+"]
BROAD = ["0-4", "5-11", "12-17", "18-59", "60+"]


def text_of(column: str, texts: dict[str, str]) -> str:
    """CASE that spells out the codes of a column."""
    whens = " ".join(f"WHEN '{c}' THEN '{t}'" for c, t in texts.items())
    return f"CASE cast({column} AS varchar) {whens} ELSE cast({column} AS varchar) END"


def _collapse(origin: str) -> str:
    return (
        f"CASE WHEN {origin} IN ('NATION_3','NATION_12','NATION_18','NATION_21') THEN {origin} "
        "WHEN originHcrRegion = 'MIDDLE EAST' THEN 'OtherA' ELSE 'OtherB' END")


VIEWS = {
    "hh_drawn": f"""
SELECT o_orderkey AS _index, 'person ' || o_custkey AS adult_name, 'person ' || o_custkey AS fam_name1,
  {_HH_ANSWERS}
FROM orders""",
    "items": """
SELECT *, cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey,
    l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS int) AS member_no
FROM lineitem""",
    "adult_items": """
SELECT l_orderkey, member_no FROM items
WHERE l_partkey % 97 <> 0 AND cast(l_quantity AS int) * 2 - 2 + l_linenumber % 2 >= 18""",
    "hh_raw": """
SELECT * REPLACE ((SELECT cast(coalesce(min(member_no) FILTER (member_no >= cast(h.selected_adult AS int)),
    min(member_no)) AS varchar) FROM adult_items a
  WHERE a.l_orderkey = h._index AND h.selected_adult IS NOT NULL) AS selected_adult)
FROM hh_drawn h""",
    "s1_keys": """
SELECT l_orderkey * 1000000000 + member_no AS _index, l_orderkey AS _parent_index, member_no,
  'person ' || (l_orderkey * 1000000000 + member_no) AS R01,
  CASE WHEN l_linestatus = 'F' THEN 'Female' ELSE 'Male' END AS R02,
  CASE WHEN l_partkey % 97 <> 0 THEN cast(l_quantity AS int) * 2 - 2 + l_linenumber % 2 END AS R03,
  CASE WHEN l_partkey % 193 = 0 THEN NULL WHEN l_linenumber = 1 THEN '1' ELSE '2' END AS R02_rel,
  l_partkey % 211 = 0 AS silent,
  CASE WHEN l_orderkey % 307 = 0 THEN '99' WHEN sn.n_name = 'NATION_8' THEN '1' WHEN l_partkey % 41 = 0 THEN '99'
    WHEN l_partkey % 43 = 0 THEN '98' ELSE '2' END AS REF01,
  CASE WHEN l_partkey % 47 = 0 THEN '77' ELSE sn.n_name END AS REF02,
  CASE WHEN l_orderkey % 307 = 0 THEN NULL WHEN l_partkey % 53 = 0 THEN '98' WHEN l_partkey % 59 = 0 THEN NULL ELSE cn.n_name END AS REF06
FROM items LEFT JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation cn ON c_nationkey = cn.n_nationkey
LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation sn ON s_nationkey = sn.n_nationkey""",
    "s1_raw": f"""
SELECT * EXCLUDE (silent) REPLACE ({", ".join(f"CASE WHEN silent THEN '98' ELSE {d} END AS {d}" for d in _DIS)})
FROM (SELECT *,
  {_S1_GIVEN}
FROM s1_keys)""",
    "s1_flags": f"""
SELECT *, ({_SOME}) AS disSum234, ({_SEVERE}) AS disSum34, ({_REFUSED}) AS refused,
  ({_UNABLE}) AS unable, ({_DOC5})::int AS doc5plus, ({_DOC04})::int AS doc04,
  CASE REF01 WHEN '1' THEN 'NATION_8' WHEN '99' THEN '99' WHEN '2' THEN REF02 WHEN '98' THEN REF02
    END AS citizenship
FROM s1_raw""",
    "s1_demo": """
SELECT *,
  CASE WHEN R03 BETWEEN 0 AND 4 THEN 1 WHEN R03 BETWEEN 5 AND 11 THEN 2 WHEN R03 BETWEEN 12 AND 17 THEN 3
    WHEN R03 BETWEEN 18 AND 24 THEN 4 WHEN R03 BETWEEN 25 AND 49 THEN 5
    WHEN R03 BETWEEN 50 AND 59 THEN 6 WHEN R03 >= 60 THEN 7 END AS R03cat,
  CASE WHEN R03 BETWEEN 0 AND 4 THEN 1 WHEN R03 BETWEEN 5 AND 11 THEN 2 WHEN R03 BETWEEN 12 AND 17 THEN 3
    WHEN R03 BETWEEN 18 AND 59 THEN 4 WHEN R03 >= 60 THEN 5 END AS R03cat2,
  CASE WHEN citizenship IS NULL THEN NULL
    WHEN citizenship NOT IN ('77','98','99') THEN citizenship
    WHEN REF06 IN ('77','98','99','NATION_8') THEN NULL ELSE REF06 END AS originAux,
  CASE WHEN refused THEN 98 ELSE (disSum234 > 0)::int END AS DISABILITY1,
  CASE WHEN refused THEN 98 ELSE (disSum234 > 1 OR disSum34 > 0)::int END AS DISABILITY2,
  CASE WHEN refused THEN 98 ELSE (disSum34 > 0)::int END AS DISABILITY3,
  CASE WHEN refused THEN 98 ELSE unable::int END AS DISABILITY4,
  CASE WHEN R03 < 5 THEN doc04 WHEN R03 >= 5 THEN doc5plus END AS documents
FROM s1_flags""",
    "head_counts": """
SELECT *, count(*) OVER hhold AS size, count(R02_rel) OVER hhold AS answered,
  count(*) FILTER (R02_rel = '1') OVER hhold AS declared,
  row_number() OVER (PARTITION BY _parent_index ORDER BY R03 DESC NULLS LAST, _index) AS age_rank,
  row_number() OVER (PARTITION BY _parent_index, R02_rel
    ORDER BY R03 DESC NULLS LAST, _index) AS rank_in_relation
FROM s1_demo WINDOW hhold AS (PARTITION BY _parent_index)""",
    "s1_head": """
SELECT *, CASE WHEN answered < size THEN NULL
    WHEN declared = 0 THEN (age_rank = 1)::int
    ELSE (R02_rel = '1' AND rank_in_relation = 1)::int END AS householdHead
FROM head_counts""",
    "rolled_counts": """
SELECT _parent_index, count(*) AS hhsize,
  sum((DISABILITY3 = 1)::int) AS disabled,
  CASE WHEN count(citizenship) = count(*) THEN sum((citizenship = 'NATION_8')::int) END AS hhNationals,
  CASE WHEN count(R03) = count(*) THEN sum((R03 >= 18)::int) END AS hhadults,
  coalesce(sum((R03 >= 18)::int), 0) AS adults_known
FROM s1_demo GROUP BY _parent_index""",
    "rolled": """
SELECT _parent_index, hhsize, cast(hhNationals AS bigint) AS hhNationals,
  cast(hhadults AS bigint) AS hhadults, cast(adults_known AS bigint) AS adults_known,
  (disabled > 0)::int AS hhdisability3,
  CASE WHEN hhsize = 1 THEN '1' WHEN hhsize < 4 THEN '2-3' WHEN hhsize < 6 THEN '4-5' ELSE '6+' END AS hhsizecat,
  (hhsize = hhNationals)::int AS allNationals
FROM rolled_counts""",
    "origin_ranked": """
SELECT *, row_number() OVER (PARTITION BY _parent_index ORDER BY n DESC, originAux DESC) AS by_count,
  row_number() OVER (PARTITION BY _parent_index ORDER BY originAux DESC) AS by_value
FROM (SELECT _parent_index, originAux, count(*) AS n FROM s1_demo
  WHERE originAux <> 'NATION_8' GROUP BY 1, 2)""",
    "hh_origin": "SELECT _parent_index, originAux AS originAux2 FROM origin_ranked WHERE by_count = 1",
    "hh_ind1": """
SELECT *,
  CASE WHEN BANK01 = '2' AND BANK04 = '2' AND BANK05 = '2'
      AND (BANK02 = '2' OR coalesce(BANK03, '2') = '2') THEN 0
    WHEN BANK01 = '1' OR BANK04 = '1' OR BANK05 = '1' OR (BANK02 = '1' AND BANK03 = '1') THEN 1 END AS banking,
  CASE WHEN HACC03 = '1' THEN 0 WHEN HACC03 = '2' AND HACC01 = '1' THEN 1 END AS healthaccess,
  CASE WHEN COOK01 <> '1' THEN NULL
    WHEN COOK03 IN ('1','2','3','4','5') THEN 1 WHEN COOK03 IN ('7','8','9','10') THEN 0
    WHEN COOK03 IN ('6','96') THEN (coalesce(COOK04, '') IN ('1','2','3','22'))::int END AS cookingfuel,
  CASE WHEN SAF01 IN ('1','2') THEN 1 WHEN SAF01 IN ('3','4') THEN 2 WHEN SAF01 = '97' THEN 97
    WHEN SAF01 IN ('98','99') THEN 98 END AS SAF01SDG,
  CASE WHEN DWA01 IN ('7','9','13','17','98') THEN 0 WHEN DWA01 IN
    ('1','2','3','4','5','6','8','10','11','12','14','15','16') THEN 1 END AS improvedDrinkingWater,
  CASE WHEN DWA03a <> '98' THEN cast(DWA03a AS double)
    * CASE DWA03b WHEN '1' THEN 1 WHEN '2' THEN 60 END END AS DWA03,
  CASE WHEN TOI01 IN ('11','12','13','21','22','31') THEN 1
    WHEN TOI01 IN ('14','18','23','41','51','85','96') THEN 0 END AS improvedSanitation,
  CASE WHEN LIGHT03 IN ('0','7') OR LIGHT01 = '2' THEN 0 WHEN LIGHT01 = '1' THEN 1 END AS electricity
FROM hh_raw""",
    "hh_ind2": """
SELECT *,
  CASE WHEN improvedDrinkingWater = 0 THEN 0
    WHEN improvedDrinkingWater = 1 THEN CASE coalesce(DWA02, 'none')
      WHEN '1' THEN 1 WHEN '2' THEN 1 WHEN '3' THEN (DWA03 <= 30)::int
      WHEN 'none' THEN (coalesce(DWA03, 0) <= 30)::int END END AS basicDrinkingWater,
  CASE WHEN improvedSanitation = 0 OR TOI05 <> '2' THEN 0
    WHEN improvedSanitation = 1 AND TOI05 = '2' THEN 1 END AS basicSanitation
FROM hh_ind1""",
    "hh_ind": """
SELECT *, CASE WHEN least(basicDrinkingWater, basicSanitation, cookingfuel, electricity) = 0 THEN 0
    WHEN basicDrinkingWater + basicSanitation + cookingfuel + electricity = 4 THEN 1 END AS basicFacilities
FROM hh_ind2""",
    "hh_base": """
SELECT h.*, hhsize, hhNationals, hhadults, adults_known, hhdisability3, hhsizecat, allNationals, originAux2
FROM hh_ind h LEFT JOIN rolled r ON h._index = r._parent_index
LEFT JOIN hh_origin o ON h._index = o._parent_index""",
    "s1_origin": """
SELECT s.*, cookingfuel, electricity, basicSanitation, basicDrinkingWater, basicFacilities,
  originAux2, hhadults,
  coalesce(originAux, originAux2, CASE WHEN REF06 = 'NATION_8' THEN citizenship ELSE REF06 END) AS origin
FROM s1_demo s LEFT JOIN hh_base b ON s._parent_index = b._index""",
    "countries": """
SELECT n_name AS iso3, r_name AS hcr_region, 'Country ' || n_nationkey AS name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey""",
    "hh_linked": """
SELECT b.*, s._index AS respondent, s.R02, s.R03, s.R02_rel, s.R03cat, s.R03cat2, s.citizenship,
  s.REF06, s.documents, s.DISABILITY3, s.origin,
  CASE WHEN s.R03 < 18 THEN 0 WHEN s.R03 >= 18 THEN 1 END AS workingAge
FROM hh_base b LEFT JOIN s1_origin s
  ON b._index = s._parent_index AND cast(b.selected_adult AS int) = s.member_no""",
    "hh_work1": """
SELECT *, CASE WHEN UNEM01 = '1' THEN 'paid'
    WHEN UNEM01 = '2' AND '1' IN (UNEM02, UNEM03) THEN 'own'
    WHEN UNEM01 = '2' AND UNEM02 = '2' AND UNEM03 = '2' THEN
      CASE WHEN UNEM04 = '1' THEN 'paid' WHEN UNEM05 = '1' THEN 'own' WHEN UNEM05 = '2' THEN 'none' END
    END AS work
FROM hh_linked""",
    "hh_work2": """
SELECT *, CASE work WHEN 'own' THEN CASE WHEN UNEM07 = '3' THEN 'paid' WHEN UNEM07 IN ('1','2') THEN 'farm' END
    WHEN 'none' THEN CASE WHEN UNEM06 = '3' THEN 'unpaid' WHEN UNEM06 IN ('1','2') THEN 'farm' END
    ELSE work END AS activity
FROM hh_work1""",
    "hh_work3": """
SELECT *, CASE activity WHEN 'farm' THEN CASE WHEN UNEM08 IN ('1','2') THEN 'paid'
      WHEN UNEM08 IN ('3','4') THEN 'unpaid' END ELSE activity END AS outcome
FROM hh_work2""",
    "hh_clean": """
SELECT *, CASE WHEN outcome = 'paid' THEN 0
    WHEN outcome = 'unpaid' AND UNEM09 = '1' AND UNEM10 = '1' THEN 1 END AS employmentStatus,
  CASE WHEN workingAge = 1 THEN (outcome = 'paid' OR (outcome = 'unpaid'
    AND coalesce(UNEM09 = '1' AND UNEM10 = '1', false))) IS TRUE END::int AS labourForce
FROM hh_work3""",
    "dem_cells": """
SELECT code AS origin_iso3, k AS n_nationkey, pos, CASE WHEN (k + pos) % 11 <> 0 THEN
  (50 + (k * 37 + pos * 11) % 100) * (SELECT cast(floor(count(*) / 1000) AS bigint) FROM lineitem) END AS n
FROM (SELECT n_nationkey AS k, n_name AS code FROM nation UNION ALL SELECT count(*), '98' FROM nation),
  range(10) AS cells(pos)""",
    "origins": """
SELECT origin_iso3, """ + ",\n  ".join(
        f"cast(coalesce(sum(n) FILTER (pos = {p}), 0) AS bigint) AS {c}" for p, c in enumerate((
            "female_0_4", "female_5_11", "female_12_17", "female_18_59", "female_60",
            "male_0_4", "male_5_11", "male_12_17", "male_18_59", "male_60"))) + """,
  cast(sum(n) AS bigint) AS totalEndYear, coalesce(any_value(hcr_region), 'Unknown') AS originHcrRegion
FROM dem_cells LEFT JOIN countries ON origin_iso3 = iso3 GROUP BY origin_iso3""",
    "margin_long": f"""
SELECT CASE WHEN pos < 5 THEN 'Female' ELSE 'Male' END AS sex,
  CASE WHEN pos % 5 < 3 THEN 'Child' ELSE 'Adult' END AS agegroup, n,
  {_collapse('origin_iso3')} AS origin_ps
FROM (SELECT d.*, coalesce(hcr_region, 'Unknown') AS originHcrRegion
  FROM dem_cells d LEFT JOIN countries ON origin_iso3 = iso3)""",
    "margin_adult": """
SELECT origin_ps || '_' || sex AS originSex_ps, cast(sum(n) AS bigint) AS Freq
FROM margin_long WHERE agegroup = 'Adult' GROUP BY 1""",
    "margin_member": """
SELECT origin_ps || '_' || agegroup || '_' || sex AS originAgeSex_ps, cast(sum(n) AS bigint) AS Freq
FROM margin_long GROUP BY 1""",
    "s1_strata": f"""
SELECT *, origin_ps || '_' || R03bin || '_' || R02 AS originAgeSex_ps FROM (
  SELECT *, {_collapse('origin')} AS origin_ps, CASE WHEN R03 < 18 THEN 'Child' ELSE 'Adult' END AS R03bin
  FROM (SELECT s.*, coalesce(hcr_region, 'Unknown') AS originHcrRegion
    FROM s1_origin s LEFT JOIN countries ON s.origin = iso3)
  WHERE R03 IS NOT NULL AND origin <> 'NATION_8')""",
    "hh_strata": f"""
SELECT *, origin_ps || '_' || R02 AS originSex_ps FROM (
  SELECT *, {_collapse('origin')} AS origin_ps
  FROM (SELECT h.*, coalesce(hcr_region, 'Unknown') AS originHcrRegion
    FROM hh_clean h LEFT JOIN countries ON h.origin = iso3)
  WHERE origin <> 'NATION_8')""",
    "member_base": """
SELECT *, (SELECT sum(Freq) FROM margin_member)::double / count(*) OVER () AS dweight,
  count(*) OVER () / (SELECT sum(Freq) FROM margin_member)::double AS fpc
FROM s1_strata""",
    "adult_base": """
SELECT *, adults_known * (SELECT sum(Freq) FROM margin_adult)::double / sum(adults_known) OVER () AS dweight,
  count(*) OVER () / (SELECT sum(Freq) FROM margin_adult)::double AS fpc
FROM hh_strata""",
    "member_ps": """
SELECT m.*, dweight * Freq / sum(dweight) OVER (PARTITION BY originAgeSex_ps) AS weight_ps
FROM member_base m JOIN margin_member USING (originAgeSex_ps)""",
    "adult_ps": """
SELECT a.*, dweight * Freq / sum(dweight) OVER (PARTITION BY originSex_ps) AS weight_ps
FROM adult_base a JOIN margin_adult USING (originSex_ps)""",
}


def with_views(body: str, extra: dict[str, str] | None = None) -> str:
    """The query with those views in front that it needs, directly or not."""
    known = {**VIEWS, **(extra or {})}
    order = list(known)

    def named(text: str) -> set[str]:
        return set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text)) & set(known)

    needed: set[str] = set()
    pending = named(body)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending |= named(known[name]) - {name}
    parts = ",\n".join(f"{n} AS ({known[n].strip()})" for n in order if n in needed)
    return f"WITH {parts}\n{body.strip()}" if parts else body.strip()
