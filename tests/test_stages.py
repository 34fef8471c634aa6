import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyspark.catalog import queries as Q
from surveyspark.functions.labels import variable_label
from surveyspark.operators import linkage
from surveyspark.operators.design import SurveyDesign
from surveyspark.operators.estimate import estimate
from surveyspark.plans import clean, report, weight
from surveyspark.sources import forms, standin, tables
from surveyspark.sources.profile import HOUSEHOLD_IDENTIFIERS, MEMBER_IDENTIFIERS, MEMBER_WORK_COLUMNS
from surveyspark.sources.standin import PROFILE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def designs(spark):
    return Q.report_designs(spark, SF)


def test_clean_tables(spark):
    made = clean.clean(standin.households(spark, SF), standin.members(spark, SF), PROFILE)
    hh, s1 = tables.stage(made.hh, "hh"), tables.stage(made.s1, "s1")
    assert hh.count() == 1500 and s1.count() == 6000
    assert not set(s1.columns) & {*MEMBER_IDENTIFIERS, *MEMBER_WORK_COLUMNS}
    assert "adult_name" not in hh.columns and "employed" not in hh.columns
    heads = s1.groupBy("_parent_index").agg(
        F.sum("householdHead").alias("heads"), F.count("householdHead").alias("known"))
    assert heads.filter("known > 0 and heads <> 1").count() == 0
    assert variable_label(s1, "documents") == "Valid identity documents or credentials"


def test_stages_of_a_run_can_be_removed(spark, tmp_path, monkeypatch):
    from surveyspark.sources import stages

    monkeypatch.setattr(stages, "shared_dir", lambda spark: str(tmp_path))
    assert tables.stage(spark.range(3), "x").count() == 3 and list(tmp_path.rglob("*.parquet"))
    tables.drop_stages(spark)
    assert not list(tmp_path.rglob("*.parquet"))


def test_no_identifier_is_ever_written(spark, monkeypatch):
    written = []
    plain = clean.stage_counted

    def stage_counted(df, name, measures):
        written.append(set(df.columns))
        return plain(df, name, measures)

    monkeypatch.setattr(clean, "stage_counted", stage_counted)
    clean.clean(standin.households(spark, SF), standin.members(spark, SF), PROFILE)
    assert len(written) == 2
    assert not set().union(*written) & {*MEMBER_IDENTIFIERS, *HOUSEHOLD_IDENTIFIERS}


def test_members_without_age_fail_unless_left_out(spark):
    rows = [(1, "NATION_3", "Male", 30), (2, "NATION_3", "Female", None), (3, "NATION_8", "Male", None)]
    s1 = spark.createDataFrame(rows, "_index long, origin string, R02 string, R03 int")
    lands = spark.createDataFrame([("NATION_3", "ASIA")], "iso3 string, hcr_region string")
    with pytest.raises(Exception, match="without age"):
        weight.member_rows(s1, lands, PROFILE).collect()
    kept = weight.member_rows(s1, lands, PROFILE, missing_age="leave_out")
    assert [r._index for r in kept.collect()] == [1]
    assert [r._index for r in weight.foreign_without_age(s1, PROFILE).collect()] == [2]
    assert weight.member_rows(s1.filter("_index <> 2"), lands, PROFILE).count() == 1


def test_respondents_join_needs_keys_of_the_forms_only(spark):
    plan = standin.households(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "BANK01" in plan and "BANK01" not in plan.split("Join LeftOuter", 1)[1]


def test_roster_has_nations_without_another_shuffle(spark, monkeypatch):
    plans = {}
    plain = standin.stage

    def stage(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(standin, "stage", stage)
    items = standin.roster(spark, SF)
    assert plans["roster"].count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_suppkey" not in plans["roster"]
    whole = standin.members(spark, SF)
    assert sorted(map(repr, standin.members(spark, SF, items=items).collect())) == sorted(map(repr, whole.collect()))


def test_interviews_are_not_shuffled_by_origin(spark, monkeypatch):
    plans = {}
    plain = weight.stage

    def stage(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return plain(df, name)

    monkeypatch.setattr(weight, "stage", stage)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        Q.report_designs(spark, SF)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for name in ("foreign-members", "foreign-adults"):
        assert "Exchange" in plans[name] and "hashpartitioning" not in plans[name]


def test_every_respondent_is_an_adult(spark):
    hh = standin.households(spark, SF)
    members = standin.members(spark, SF, questions=(), origins=False)
    linked = linkage.link_respondent(hh, members, ["R03"])
    assert linked.filter("selected_adult is not null and (R03 is null or R03 < 18)").count() == 0
    drawn = standin.households(spark, SF, respondent=False)
    assert linked.filter("_found").count() > 0.7 * drawn.count()


def test_a_household_of_very_many_members_has_keys_of_its_own(spark, tmp_path):
    crowd = 50_000
    items = spark.range(crowd + 3).select(
        F.when(F.col("id") < crowd, 1).otherwise(F.col("id") - crowd + 2).cast("long").alias("l_orderkey"),
        (F.col("id") % 7 + 1).alias("l_linenumber"), (F.col("id") % 2000 + 1).alias("l_partkey"),
        (F.col("id") % 10).alias("l_suppkey"), (F.col("id") % 50 + 1).cast("double").alias("l_quantity"),
        F.col("id").cast("double").alias("l_extendedprice"), F.current_date().alias("l_shipdate"),
        F.lit("F").alias("l_linestatus"))
    items.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(2000).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    members = standin.members(spark, str(tmp_path), questions=(), origins=False)
    seen = members.agg(F.countDistinct("_index"), F.countDistinct("_parent_index"), F.max("member_no")).first()
    assert tuple(seen) == (crowd + 3, 4, crowd)
    flat = Q.submissions_flatten(spark, str(tmp_path))
    joined = flat.join(members.select("_parent_index", "member_no"), ["_parent_index", "member_no"])
    assert flat.count() == joined.count() == crowd + 3


def test_designs_meet_their_margins(spark, designs):
    for design in (designs.foreign_members, designs.foreign_adults):
        total = design.df.agg(F.sum(design.weight)).first()[0]
        assert total == pytest.approx(round(total), abs=1e-4)
    members = designs.foreign_members.df
    assert members.agg(F.sum("weight_ps")).first()[0] == pytest.approx(Q.origins(spark, SF).agg(F.sum("totalEndYear")).first()[0])


def test_report_layout(designs):
    rows = report.full_report(designs).orderBy("table_no", "row_no").collect()
    assert [r.table_no for r in rows] == sorted(r.table_no for r in rows)
    assert {r.table_no for r in rows} == set(range(1, 19))
    for no in range(1, 19):
        table = [r for r in rows if r.table_no == no]
        assert table[0]["Unit of analysis"] and not any(r["Unit of analysis"] for r in table[1:])
        assert [r.Answers for r in table[-2:]] == [report.WEIGHTED_BASE, report.UNWEIGHTED_BASE]
        assert sum(r.Total for r in table[:-2]) == pytest.approx(1)
        assert table[-2].n == pytest.approx(sum(r.n for r in table[:-2]))
        # sex is a post-stratum: its share has no sampling error and the limits equal it up to rounding
        assert all(r.low - 1e-12 <= r.Total <= r.upp + 1e-12 for r in table[:-2])
    columns = report.full_report(designs).columns
    assert columns[2:6] == ["Indicator", "Unit of analysis", "Question", "Answers"]
    assert columns[6:] == ["n", *report.column_names(report.LEVELS)]


def test_tables_and_designs_round_trip(spark, designs, tmp_path):
    folder = str(tmp_path)
    design = designs.foreign_adults.filter("labourForce = 'In the labour force'")
    tables.save_tables({"adults": design.df}, folder)
    tables.save_designs({"adults_design": design, "all": designs.foreign_adults}, folder)
    back = tables.load_design(spark, folder, "adults_design")
    assert back.settings() == design.settings()
    want = sorted(map(tuple, estimate(design, "employmentStatus").collect()))
    assert sorted(map(tuple, estimate(back, "employmentStatus").collect())) == want
    assert tables.load_design(spark, folder, "all").domain is None
    loaded = tables.load_table(spark, folder, "adults")
    assert variable_label(loaded, "labourForce") == "Labour force"


def test_report_files(spark, designs, tmp_path):
    small = report.full_report(designs, report.REPORT[:1])
    tables.save_report(small, str(tmp_path), ["table_no", "row_no"])
    text = spark.read.option("header", True).csv(f"{tmp_path}/report_csv")
    assert text.columns[:4] == ["Indicator", "Unit of analysis", "Question", "Answers"]
    assert text.count() == spark.read.parquet(f"{tmp_path}/report").count() == 6


def test_shared_dir_must_be_named_on_a_cluster(spark, monkeypatch):
    class Elsewhere:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Elsewhere()

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        tables.shared_dir(Session())


def test_submissions_from_json(spark, tmp_path):
    records = [
        {"_id": 7, "BANK01": "1", "S1A": [{"R03": 30}, {"R03": 4}], "S1B": [{"DIS01": "1"}]},
        {"_id": 8, "BANK01": "2", "S1A": [], "S1B": None},
    ]
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, records)))
    schema = T._parse_datatype_string(
        "_id bigint, BANK01 string, S1A array<struct<R03: int>>, S1B array<struct<DIS01: string>>")
    made = forms.flatten(forms.read_submissions(spark, str(tmp_path), schema), ["S1A", "S1B"])
    assert sorted(map(tuple, made["main"].collect())) == [(7, "1"), (8, "2")]
    assert sorted(map(tuple, made["S1A"].collect())) == [(7, 1, 30), (7, 2, 4)]
    assert sorted(map(tuple, made["S1B"].collect())) == [(7, 1, "1")]


def test_derived_column_on_a_design(designs):
    design: SurveyDesign = designs.foreign_members.with_columns({"R02x": F.col("R02")})
    assert {r.answer for r in estimate(design, "R02x").collect()} == {"Female", "Male"}


def test_flattened_submissions_have_the_keys_of_the_members(spark):
    flat = Q.submissions_flatten(spark, SF)
    assert flat.columns == ["_index", "_parent_index", "member_no", "R02_rel", "R03"]
    keys = ["_index", "_parent_index", "member_no"]
    members = standin.members(spark, SF, questions=(), origins=False).select(keys)
    assert flat.count() == 6000 and flat.select(keys).exceptAll(members).isEmpty()
