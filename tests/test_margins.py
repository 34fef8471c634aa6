import pytest

from surveyspark.operators import margins as M
from surveyspark.operators import quality as Q
from surveyspark.sources.profile import Profile

PROFILE = Profile()


def dem(spark):
    cells = {c: i for i, c in enumerate(M.CELLS, start=1)}
    def row(origin, iso3, year=2021, kind="REF", **over):
        v = {**cells, **over}
        female = sum(v[c] or 0 for c in M.FEMALE)
        male = sum(v[c] or 0 for c in M.MALE)
        return (year, "GEO", origin, iso3, kind, *[v[c] for c in M.CELLS], female, male, female + male)
    data = [row("IRN", "IRN"), row("IRN", "IRN", kind="ASY", female_0_4=None), row("UKN", "XXX"),
            row("SYR", "SYR"), row("RUS", "RUS", year=2020), row("RUS", "RUS", kind="ROC"),
            row("FRA", "FRA")]
    schema = ("year int, asylum_iso3 string, origin string, origin_iso3 string, populationType string, "
              + ", ".join(f"{c} long" for c in M.CELLS) + ", female long, male long, totalEndYear long")
    return spark.createDataFrame(data, schema)


def countries(spark):
    return spark.createDataFrame(
        [("IRN", "Asia"), ("SYR", "Middle East and North Africa"), ("FRA", "Europe")],
        "iso3 string, hcr_region string")


def test_cells_add_up(spark):
    checked = M.check_cells(M.in_scope(dem(spark), PROFILE))
    assert checked.count() == 5
    assert checked.filter("checkFemaleDiff <> 0 or checkMaleDiff <> 0 or checkTotalEndYearDiff <> 0").count() == 0


def test_margins(spark):
    origins = M.by_origin(M.in_scope(dem(spark), PROFILE), countries(spark), PROFILE)
    got = {r.origin_iso3: (r.totalEndYear, r.originHcrRegion) for r in origins.collect()}
    assert got == {"IRN": (109, "Asia"), "98": (55, "Unknown"),
                   "SYR": (55, "Middle East and North Africa"), "FRA": (55, "Europe")}
    adults = {r.originSex_ps: r.Freq for r in M.adult_margin(origins, PROFILE).collect()}
    assert adults["IRN_Female"] == 18 and adults["OtherMENA_Male"] == 19
    assert adults["OtherNotMENA_Female"] == 18
    members = {r.originAgeSex_ps: r.Freq for r in M.member_margin(origins, PROFILE).collect()}
    assert members["IRN_Child_Female"] == 11 and members["OtherNotMENA_Adult_Male"] == 38
    assert sum(members.values()) == 274
    shares = M.member_counts(origins).filter("origin_iso3 = 'SYR'").first()
    assert shares.percAdult_Male == pytest.approx(19 / 55)


def test_tables_and_summaries(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, None), ("b", 4)], "k string, v int")
    assert {r.k: r.n for r in Q.frequency(df, "k").collect()} == {"a": 2, None: 1, "b": 1}
    assert {r.k: r.perc for r in Q.distribution(df, "k").collect()} == {"a": 0.5, None: 0.25, "b": 0.25}
    assert {r.k: r.perc for r in Q.proportions(df, "k").collect()} == {
        "a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}
    assert tuple(Q.duplicate_keys(df, ["k"]).first()) == (4, 3, 1)
    s = Q.column_summary(df, ["v"]).first()
    assert (s.n_rows, s.n_missing, s.min, s.q1, s.median, s.q3, s.max) == (4, 1, 1, 2, 3, 3.5, 4)
    assert s["mean"] == pytest.approx(8 / 3)
