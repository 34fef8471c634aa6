import pytest
from pyspark.sql import functions as F

from surveyspark.operators import household as H
from surveyspark.operators import linkage as K
from surveyspark.sources.profile import Profile

PROFILE = Profile()

# household, member, age, relation; expected head flag
HEADS = [
    (1, 11, 40, "1", 1), (1, 12, 70, "2", 0),                        # one declared
    (2, 21, 30, "2", 0), (2, 22, 50, "2", 1), (2, 23, None, "2", 0),  # none: the oldest
    (3, 31, 30, "1", 0), (3, 32, 60, "1", 1), (3, 33, 90, "2", 0),   # two: the oldest of them
    (4, 42, 50, "2", 0), (4, 41, 50, "2", 1),                        # tie: the lowest key
    (5, 52, None, "2", 0), (5, 51, None, "2", 1),                    # no age at all
    (6, 61, 40, "1", None), (6, 62, 30, None, None),                 # a missing relation
]


def members(spark):
    data = [(p, i, a, r) for p, i, a, r, _ in HEADS]
    df = spark.createDataFrame(data, "_parent_index bigint, _index bigint, R03 int, R02_rel string")
    return df.withColumn("member_no", (F.col("_index") % 10).cast("int"))


def test_head_of_household(spark):
    got = {r._index: r.householdHead for r in H.mark_heads(members(spark)).collect()}
    assert got == {i: e for _, i, _, _, e in HEADS}


def test_missing_relation_can_be_skipped(spark):
    got = {r._index: r.householdHead for r in H.mark_heads(members(spark), "skip").collect()}
    assert (got[61], got[62]) == (1, 0)


def full_members(spark):
    schema = ("_parent_index bigint, _index bigint, R02 string, R03 int, R02_rel string, R03cat int, "
              "R03cat2 int, citizenship string, REF06 string, DISABILITY3 int, originAux string")
    data = [
        (1, 11, "Female", 40, "1", 5, 4, "GEO", "GEO", 1, "GEO"),
        (1, 12, "Male", 17, "2", 3, 3, "GEO", "GEO", 0, "GEO"),
        (2, 21, "Male", 30, "1", 5, 4, "IRN", "IRN", 98, "IRN"),
        (2, 22, "Male", None, "2", None, None, "GEO", None, 0, "GEO"),
        (2, 23, "Male", 3, "2", 1, 1, "IRN", None, 0, "IRN"),
        (2, 24, "Male", 3, "2", 1, 1, "UKR", None, 0, "UKR"),
    ]
    return spark.createDataFrame(data, schema).withColumn("member_no", (F.col("_index") % 10).cast("int"))


def test_heads_are_hash_aggregates(spark):
    plan = H.mark_heads(members(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_keys_of_large_households(spark):
    df = spark.createDataFrame(
        [(2**62, n, a, "2") for n, a in ((1, 0), (4_000_000_000, 50), (3_999_999_999, 50), (2, None))],
        "_parent_index bigint, member_no bigint, R03 int, R02_rel string")
    assert [r.member_no for r in H.mark_heads(df).filter("householdHead = 1").collect()] == [3_999_999_999]


def test_roll_up_and_head_attributes(spark):
    df = full_members(spark)
    got = {r._parent_index: r for r in H.roll_up_with_head(df, PROFILE).collect()}
    assert (got[1].hhsize, got[1].hhadults, got[1].hhNationals) == (2, 1, 2)
    assert (got[1].hhdisability3, got[1].hhsizecat, got[1].allNationals) == (1, "2-3", 1)
    assert (got[1].headHHR02, got[1].headHHR03) == ("Female", 40)
    assert (got[2].hhadults, got[2].hhdisability3, got[2].hhsizecat) == (None, 0, "4-5")
    assert (got[2].allNationals, got[2].headHHcitizenship) == (0, "IRN")


def test_one_pass_equals_join_of_marked_heads(spark):
    df = full_members(spark)
    one = H.roll_up_with_head(df, PROFILE)
    two = H.attach_head(H.roll_up(df, PROFILE), H.mark_heads(df)).select(*one.columns)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_household_origin(spark):
    df = full_members(spark)
    by_count = {r._parent_index: r.originAux2 for r in H.household_origin(df, PROFILE).collect()}
    by_value = {r._parent_index: r.originAux2 for r in H.household_origin(df, PROFILE, "value").collect()}
    assert by_count == {2: "IRN"} and by_value == {2: "UKR"}


def test_household_origin_of_ties_in_one_shuffle(spark):
    schema = "_parent_index bigint, originAux string"
    df = spark.createDataFrame([(1, "IRN"), (1, "UKR"), (2, "UKR"), (2, "IRN"), (2, "IRN"), (2, "GEO"), (2, "GEO"),
                                (3, None), (4, "GEO"), (None, "RUS"), (5, "A"), (5, "C"), (5, "B"), (5, None)], schema)
    modal = H.household_origin(df, PROFILE)
    assert modal._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert dict(map(tuple, modal.collect())) == {1: "UKR", 2: "IRN", None: "RUS", 5: "C"}


def test_head_with_some_attributes(spark):
    some = {a: n for a, n in H.HEAD_ATTRIBUTES.items() if a in ("_index", "R02")}
    whole, part = (H.roll_up_with_head(full_members(spark), PROFILE, "skip", a) for a in (H.HEAD_ATTRIBUTES, some))
    assert set(whole.columns) - set(part.columns) == set(H.HEAD_ATTRIBUTES.values()) - set(some.values())
    assert sorted(map(repr, whole.select(*part.columns).collect())) == sorted(map(repr, part.collect()))


def test_blank_rows_for_missing_origin(spark):
    df = spark.createDataFrame([("GEO", 1), ("IRN", 2), (None, 3)], "origin string, v int")
    assert [tuple(r) for r in H.not_host(df, PROFILE).collect()] == [("IRN", 2)]
    assert [tuple(r) for r in H.not_host_or_blank(df, PROFILE).collect()] == [("IRN", 2), (None, None)]


def test_number_within_a_dominating_parent(spark):
    """A parent with a third of all rows is numbered as if in one piece."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("p"),
        (F.hash("id") % 1000).alias("o"), "id")
    lead = F.floor(F.col("o") / 50)
    got = K.number_within(df, "p", ["o", "id"], lead, "no")
    big = sorted((r.o, r.id, r.no) for r in got.filter("p = 0").collect())
    assert len(big) == 1000 and [r[2] for r in big] == list(range(1, 1001))
    assert {r.no for r in got.filter("p <> 0").collect()} == {1}


def test_joins(spark):
    left = spark.createDataFrame([(1, None), (2, "b")], "k int, x string")
    right = spark.createDataFrame([(1, None, 10), (2, "c", 20)], "k int, x string, v int")
    got = {r.k: r.v for r in K.natural_left_join(left, right).collect()}
    assert got == {1: 10, 2: None}
    once = K.checked_left_join(left, right.select("k", "v"), ["k"])
    assert {r.k: r.v for r in once.collect()} == {1: 10, 2: 20}
    twice = right.select("k", "v").union(right.select("k", "v"))
    with pytest.raises(Exception, match="repeated key"):
        K.checked_left_join(left, twice, ["k"]).collect()
    assert K.fan_out(twice, ["k"]).count() == 2


def test_respondent_link_ignores_unselected(spark):
    hh = spark.createDataFrame([(1, 2), (2, None)], "_index bigint, selected_adult int")
    s1 = spark.createDataFrame([(1, 1, 30), (1, 2, 40), (2, 1, 50)],
                               "_parent_index bigint, member_no int, R03 int")
    got = sorted(tuple(r) for r in K.link_respondent(hh, s1, ["R03"]).collect())
    assert got == [(1, 2, 40, True), (2, None, None, False)]


def test_merge_rosters_on_name_and_age(spark):
    a = spark.createDataFrame([(1, "ann", None, "F")], "_parent_index int, R01 string, R03 int, R02 string")
    b = spark.createDataFrame([(1, "ann", None, "1")], "_parent_index int, nm string, ag int, rel string")
    out = K.merge_rosters(a, b, {"_parent_index": "_parent_index", "R01": "nm", "R03": "ag"})
    assert out.first().rel == "1"
    with pytest.raises(Exception, match="repeated key"):
        K.merge_rosters(a, b.union(b), {"_parent_index": "_parent_index", "R01": "nm", "R03": "ag"}).collect()


def test_checked_join_matches_missing_keys_and_keeps_labels(spark):
    left = spark.createDataFrame([(1,), (None,)], "k int")
    right = spark.createDataFrame([(None, 10), (1, 20)], "k int, v int")
    right = right.withMetadata("v", {"label": "Value"})
    out = K.checked_left_join(left, right, ["k"])
    assert {r.k: r.v for r in out.collect()} == {1: 20, None: 10}
    assert out.columns == ["k", "v"] and out.schema["v"].metadata == {"label": "Value"}
    with pytest.raises(Exception, match="repeated key"):
        K.checked_left_join(left, right.filter("k is null").union(right.filter("k is null")), ["k"]).collect()


def test_identifiers_are_stripped(spark):
    df = spark.createDataFrame([(1, "a", "b")], "k int, R01 string, adult_name string")
    assert K.strip_identifiers(df, ["R01", "adult_name", "absent"]).columns == ["k"]


def test_only_crowded_parents_are_numbered_by_bands(spark, monkeypatch):
    """Usual parents take one shuffle and no join; both ways give the same positions."""
    from surveyspark.operators import linkage

    rows = [(k % 5 if k % 3 else 9, k % 7, k % 50 if k % 11 else None) for k in range(400)] + [(None, 1, 1), (1, None, 2), (9, None, 3)]
    df = spark.createDataFrame(rows, "parent long, line int, part int")

    def number():
        return linkage.number_within(df, "parent", ["line", "part"], F.col("line") * 10, "no")

    one_window = number()
    plan = one_window._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    want = sorted(map(str, one_window.collect()))
    assert len(want) == 400
    assert {r.parent: r.low for r in one_window.groupBy("parent").agg(F.min("no").alias("low")).collect()} == {
        0: 1, 1: 2, 2: 1, 3: 1, 4: 1, 9: 2}
    for crowd in (0, 50, 100):
        monkeypatch.setattr(linkage, "CROWD", crowd)
        assert sorted(map(str, number().collect())) == want


def test_designs_over_one_set_of_members_number_the_roster_once(spark, monkeypatch):
    from surveyspark.catalog import queries as Q

    numbered = []
    plain = Q.standin.numbered_items
    monkeypatch.setattr(Q.standin, "numbered_items", lambda *a: numbered.append(a) or plain(*a))
    assert Q.QUERIES["design_totals"](spark, "/root/testdata/sf0.001").count() == 2
    assert len(numbered) == 1
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
