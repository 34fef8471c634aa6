import json

import pytest
from pyspark.sql import functions as F

from surveyspark.catalog import queries
from surveyspark.functions.labels import value_labels
from surveyspark.plans import clean
from surveyspark.plans.submissions import clean_from_submissions
from surveyspark.sources import forms
from surveyspark.sources.profile import Profile

PROFILE = Profile(host="GEO")
MEMBER = ("R01 string, R02 string, R02_rel string, R03 int, REF01 string, REF02 string, REF06 string, "
          + ", ".join(f"{q} string" for q in queries.FUNCTIONING + queries.DOCUMENTS))
FORM = ", ".join(f"{q} string" for q in queries.standin.HOUSEHOLD_ANSWERS if q != "selected_adult")
SCHEMA = f"_id bigint, adult_name string, selected_adult int, {FORM}, S1A array<struct<{MEMBER}>>"
BIG = 2**62 - 3


def member(age=None, relation="2", sex="Female", status="2", code="IRN", born="IRN", **answers):
    return {"R01": "same name", "R02": sex, "R02_rel": relation, "R03": age, "REF01": status, "REF02": code,
            "REF06": born, **answers}


RECORDS = [
    {"_id": 1, "adult_name": "n", "selected_adult": 2, "BANK01": "1", "S1A": [
        member(30, "1", "Male", REG01a="1"), member(30, "2", "Male", code="IRQ", DIS01="4"), member(4, "2")]},
    {"_id": BIG, "selected_adult": None, "S1A": [member(None, "2"), member(None, "2", code="RUS")]},
    {"_id": BIG + 1, "selected_adult": 9, "S1A": [member(50, "2"), member(70, None)]},
    {"_id": 4, "selected_adult": 1, "S1A": [member(70, "2", status="1"), member(70, "2", status="1"),
                                            member(20, "2", status="1")]},
    {"_id": 5, "selected_adult": 1, "S1A": []},
    {"_id": 6, "selected_adult": 1, "S1A": None},
    {"_id": 7, "selected_adult": 1, "S1A": [
        member(40, "2", code="RUS"), member(41, "1", code="IRN"), member(42, "1", code="IRN"),
        member(9, "2", code="RUS"), member(8, "2", status="98", code="77", born="GEO")]},
]


def test_named_columns_are_the_same_by_one_join(spark, submissions):
    tables = forms.flatten(submissions, ["S1A"])
    twice = tables["main"].filter("_index = 7 or _index = 4").withColumn("selected_adult", F.lit(3))
    unkeyed = tables["main"].filter("_index = 1").withColumn("_index", F.lit(None).cast("long"))
    main = tables["main"].unionByName(twice).unionByName(unkeyed)
    members = tables["S1A"].withColumn("_index", F.col("_parent_index") % 1000 * 100 + F.col("member_no"))
    lost = members.filter("_parent_index = 1").withColumn("_parent_index", F.lit(None).cast("long"))
    members = members.unionByName(members.filter("_parent_index = 4")).unionByName(lost)
    columns = ["_index", "_parent_index", "origin", "R02", "R03", "DISABILITY3", "hhadults", "allNationals", "headHHR03cat",
               "headHHcitizenship", "basicFacilities", "banking", "labourForce", "employmentStatus", "workingAge"]
    plain = clean.clean(main, members, PROFILE, missing="skip", keep_answers=False)
    named = clean.clean(main, members, PROFILE, missing="skip", keep_answers=False, columns=columns)
    assert named.checks == plain.checks
    for one, two in ((plain.hh, named.hh), (plain.s1, named.s1)):
        assert two.columns == [c for c in columns if c in one.columns]
        assert two.schema == one.select(*two.columns).schema
        assert sorted(map(repr, one.select(*two.columns).collect())) == sorted(map(repr, two.collect()))


@pytest.fixture(scope="module")
def submissions(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("forms")
    (folder / "in.json").write_text("\n".join(map(json.dumps, RECORDS)))
    return forms.read_submissions(spark, str(folder), spark.createDataFrame([], SCHEMA).schema)


@pytest.mark.parametrize("missing", ["strict", "skip"])
@pytest.mark.parametrize("pick", ["count", "value"])
def test_same_tables_as_by_joins(spark, submissions, missing, pick):
    nested = clean_from_submissions(submissions, PROFILE, origin_pick=pick, missing=missing)
    tables = forms.flatten(submissions, ["S1A"])
    small = F.col("_parent_index") < 100
    members = tables["S1A"].withColumn("_index", F.col("_parent_index") % 1000 * 100 + F.col("member_no"))
    flat = clean.clean(tables["main"], members, PROFILE, origin_pick=pick, missing=missing)
    drop = ["headHHindex", "headHHno"]
    names = sorted(set(flat.hh.columns) - set(drop))
    assert names == sorted(set(nested.hh.columns) - set(drop))
    assert sorted(map(repr, nested.hh.select(*names).collect())) == sorted(map(repr, flat.hh.select(*names).collect()))
    names = sorted(set(flat.s1.columns) - {"_index"})
    assert names == sorted(nested.s1.columns)
    assert sorted(map(repr, nested.s1.select(*names).collect())) == sorted(map(repr, flat.s1.select(*names).collect()))
    assert nested.s1.filter(small).count() == 3 + 3 + 5


def test_heads_respondents_and_keys(submissions):
    out = clean_from_submissions(submissions, PROFILE)
    hh = {r._index: r for r in out.hh.collect()}
    assert {k: (r.headHHno, r.hhsize) for k, r in hh.items()} == {
        1: (1, 3), BIG: (1, 2), BIG + 1: (None, 2), 4: (1, 3), 5: (None, None), 6: (None, None), 7: (3, 5)}
    assert (hh[1].citizenship, hh[1].DISABILITY3, hh[BIG].origin, hh[BIG + 1].R03) == ("IRQ", 1, None, None)
    assert hh[4].allNationals == 1 and hh[BIG].hhadults is None
    assert out.s1.filter("_parent_index = 7 and member_no = 5").first().origin == "RUS"  # the household's last modal one
    keys = [(r._parent_index, r.member_no) for r in out.s1.collect()]
    assert len(set(keys)) == len(keys) == 15 and (BIG + 1, 2) in keys
    assert "R01" not in out.s1.columns and "adult_name" not in out.hh.columns
    assert value_labels(out.s1, "documents") and value_labels(out.hh, "headHHR03cat") == value_labels(out.s1, "R03cat")


def test_rosters_are_derived_once(submissions):
    s1 = clean_from_submissions(submissions, PROFILE).s1
    plan = s1._jdf.queryExecution().optimizedPlan().toString()
    assert not any("Filter" in line and "transform(" in line for line in plan.splitlines())
    assert s1.filter("member_no IS NULL").isEmpty()


def test_links_are_counted_while_written(submissions):
    tables = forms.flatten(submissions, ["S1A"])
    members = tables["S1A"].withColumn("_index", F.col("_parent_index") % 1000 * 100 + F.col("member_no"))
    good = clean.clean(tables["main"], members, PROFILE, unmatched="fail").checks
    assert good == clean.LinkChecks(7, 7, 2, 15, 0, 15) and good.complete
    twice = tables["main"].union(tables["main"].filter("_index = 1"))
    assert clean.clean(twice, members, PROFILE).checks.linked == 18
    with pytest.raises(ValueError, match="do not match"):
        clean.clean(twice, members, PROFILE, unmatched="fail")
    gone = clean.clean(tables["main"].filter("_index <> 7"), members, PROFILE).checks
    assert (gone.linked, gone.members, gone.complete) == (10, 15, False)


def test_no_shuffle(submissions):
    tables = clean_from_submissions(submissions, PROFILE)
    for df in (tables.hh, tables.s1):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Aggregate" not in plan and "Join" not in plan


def test_a_household_of_fifty_thousand(spark):
    entries = F.transform(F.sequence(F.lit(1), F.lit(50_000)), lambda k: F.struct(
        *[(F.lit("x") if n == "R01" else F.lit("2") if n == "R02_rel" else (k % 90).cast("int") if n == "R03"
           else F.lit(None).cast("string")).alias(n)
          for n in spark.createDataFrame([], MEMBER).columns]))
    one = spark.range(1).select(F.lit(BIG).alias("_id"), F.lit(3).alias("selected_adult"), *[
        F.lit(None).cast("string").alias(q) for q in queries.standin.HOUSEHOLD_ANSWERS if q != "selected_adult"],
        entries.alias("S1A"))
    out = clean_from_submissions(one, PROFILE)
    assert out.s1.select("_parent_index", "member_no").distinct().count() == 50_000
    assert out.hh.first().headHHno == 89


def test_not_a_repeat_group(submissions):
    with pytest.raises(ValueError, match="not a repeat group"):
        clean_from_submissions(submissions, PROFILE, roster="BANK01")
