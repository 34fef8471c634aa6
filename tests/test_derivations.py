import itertools

import pytest

from surveyspark.operators import demographics as D
from surveyspark.operators import indicators as I
from surveyspark.sources.profile import Profile

PROFILE = Profile()


def apply(spark, step, values, *outputs):
    """Run a step on literal rows of text columns and return the outputs."""
    names = list(values[0])
    schema = ", ".join(f"{n} {'int' if n in ('R03', 'workingAge') else 'string'}" for n in names)
    df = spark.createDataFrame([tuple(v[n] for n in names) for v in values], schema)
    return [tuple(r[o] for o in outputs) for r in step(df).collect()]


@pytest.mark.parametrize("answers, expected", [
    ([None] * 6, (0, 0, 0, None)),
    (["98", "99", "98", "99", "98", "99"], (98, 98, 98, 98)),
    (["2", "1", "1", "1", "1", "1"], (1, 0, 0, 0)),
    (["2", "2", "1", "1", "1", "1"], (1, 1, 0, 0)),
    (["3", "1", "1", "1", "1", "1"], (1, 1, 1, 0)),
    (["4", None, None, None, None, None], (1, 1, 1, 1)),
    (["98", None, None, None, None, None], (0, 0, 0, None)),
])
def test_disability(spark, answers, expected):
    row = dict(zip(D.FUNCTIONING, answers))
    got = apply(spark, D.disability, [row], "DISABILITY1", "DISABILITY2", "DISABILITY3", "DISABILITY4")
    assert got == [expected]


def test_functioning_flags_are_never_missing(spark):
    row = {**dict.fromkeys(D.FUNCTIONING), "DIS02": "3"}
    got = apply(spark, D.functioning_flags, [row], "disaux1_234", "disaux2_234", "disaux2_34")
    assert got == [(False, True, True)]


@pytest.mark.parametrize("ref, expected", [
    (("1", None, "IRN"), ("GEO", "GEO")),
    (("2", "IRN", None), ("IRN", "IRN")),
    (("98", "RUS", "GEO"), ("RUS", "RUS")),
    (("99", "RUS", "IRQ"), ("99", "IRQ")),
    (("2", "77", "GEO"), ("77", None)),
    (("2", "77", None), ("77", None)),
    (("2", "77", "UKR"), ("77", "UKR")),
    ((None, "RUS", "IRQ"), (None, None)),
])
def test_citizenship(spark, ref, expected):
    row = dict(zip(("REF01", "REF02", "REF06"), ref))
    got = apply(spark, lambda d: D.citizenship(d, PROFILE), [row], "citizenship", "originAux")
    assert got == [expected]


@pytest.mark.parametrize("own, household, born, citizen, expected", [
    ("IRN", "RUS", "UKR", "77", "IRN"), (None, "RUS", "UKR", "77", "RUS"),
    (None, None, "98", "77", "98"), (None, None, "GEO", "77", "77"), (None, None, None, "77", None)])
def test_origin(spark, own, household, born, citizen, expected):
    row = {"originAux": own, "originAux2": household, "REF06": born, "citizenship": citizen}
    got = apply(spark, lambda d: D.impute_origin(d, PROFILE), [row], "origin")
    assert got == [(expected,)]


def test_documents_by_age(spark):
    base = {**dict.fromkeys(D.DOCUMENTS_FROM_5, "2"), **dict.fromkeys(D.DOCUMENTS_BELOW_5, "2")}
    young = {**base, "REG04c": "1"}
    unsure = {**base, "REG01a": None}
    rows = [{**young, "R03": 4}, {**young, "R03": 5}, {**unsure, "R03": 30}, {**base, "R03": None}]
    assert apply(spark, D.documents, rows, "documents") == [(1,), (0,), (None,), (None,)]


def test_collapsed_origins_and_strata(spark):
    rows = [{"origin": o, "originHcrRegion": r, "R02": "Male", "R03": a} for o, r, a in (
        ("IRN", "Unknown", 17), ("SYR", "Middle East and North Africa", 18), ("98", "Unknown", None))]

    def step(d):
        return D.adult_stratum(D.member_stratum(D.age_group(D.collapse_origin(d, PROFILE))))
    assert apply(spark, step, rows, "originSex_ps", "originAgeSex_ps") == [
        ("IRN_Male", "IRN_Child_Male"), ("OtherMENA_Male", "OtherMENA_Adult_Male"),
        ("OtherNotMENA_Male", "OtherNotMENA_NA_Male")]


def labour(unem, working_age):
    """Plain reading of the questionnaire, one interview at a time."""
    q = dict(zip(range(1, 11), unem))
    at_work = temp = farm = dest = employed = None
    if q[1] == "1":
        at_work = 1
    elif q[1] == "2" and q[2] == "2" and q[3] == "2":
        at_work = 2
    elif q[1] == "2" and "1" in (q[2], q[3]):
        at_work = 3
    if at_work == 2:
        temp = {("1", "1"): 1, ("1", "2"): 1, ("2", "1"): 3, ("2", "2"): 2}[q[4], q[5]]
    if at_work == 3 or temp == 3:
        farm = {"3": 1, "1": 2, "2": 2}[q[7]]
    elif temp == 2:
        farm = {"3": 0, "1": 2, "2": 2}[q[6]]
    if farm == 2:
        dest = {"1": 1, "2": 1, "3": 0, "4": 0}[q[8]]
    if (dest == 0 or farm == 0) and q[9] == "1" and q[10] == "1":
        employed = 0
    elif 1 in (at_work, temp, farm, dest):
        employed = 1
    status = None if employed is None else 1 - employed
    force = None if working_age != 1 else int(employed is not None)
    return employed, status, force


def test_labour_force_all_paths(spark):
    cases = []
    for u in itertools.product("12", "12", "12", "12", "12", "13", "13", "14", ("1", None), ("1", "2")):
        cases.append((u, 1))
    cases += [(cases[0][0], 0), (cases[0][0], None)]
    values = [
        {**{f"UNEM{i:02d}": a for i, a in enumerate(u, start=1)}, "workingAge": w} for u, w in cases]
    got = apply(spark, I.labour_force, values, "employed", "employmentStatus", "labourForce")
    assert got == [labour(u, w) for u, w in cases]


def services(spark, step, columns, cases, output):
    values = [dict(zip(columns, c)) for c, _ in cases]
    assert [r[0] for r in apply(spark, step, values, output)] == [e for _, e in cases]


def test_banking(spark):
    services(spark, I.banking, [f"BANK0{i}" for i in range(1, 6)], [
        (("2", "2", "1", "2", "2"), 0), (("2", "1", "2", "2", "2"), 0), (("2", "1", None, "2", "2"), 0),
        (("2", "1", "1", "2", "2"), 1), (("1", "2", None, "2", "2"), 1), (("2", "2", "2", "2", "1"), 1),
        (("98", "2", "2", "2", "2"), None), (("98", "2", None, "1", "2"), 1)], "banking")


def test_health_and_safety(spark):
    services(spark, I.health_access, ["HACC01", "HACC03"], [
        (("1", "1"), 0), (("1", "2"), 1), (("2", "2"), None), (("1", "98"), None)], "healthaccess")
    services(spark, I.safety, ["SAF01"], [
        (("1",), 1), (("2",), 1), (("3",), 2), (("97",), 97), (("99",), 98), ((None,), None)], "SAF01SDG")


def test_cooking_fuel(spark):
    services(spark, I.cooking_fuel, ["COOK01", "COOK03", "COOK04"], [
        (("1", "3", None), 1), (("1", "6", "22"), 1), (("1", "6", None), 0), (("1", "96", "5"), 0),
        (("1", "9", "1"), 0), (("2", "3", "1"), None), (("1", None, "1"), None)], "cookingfuel")


def test_drinking_water(spark):
    services(spark, I.drinking_water, ["DWA01", "DWA02", "DWA03a", "DWA03b"], [
        (("1", None, None, None), 1), (("1", None, "20", "1"), 1), (("1", None, "1", "2"), 0),
        (("1", "2", "40", "1"), 1), (("1", "3", "30", "1"), 1), (("1", "3", "31", "1"), 0),
        (("1", "3", "98", "1"), None), (("7", "1", None, None), 0), (("99", "1", None, None), None),
    ], "basicDrinkingWater")
    services(spark, I.drinking_water, ["DWA01", "DWA02", "DWA03a", "DWA03b"], [
        (("1", "1", "5", "1"), 5.0), (("1", "1", "1", "2"), 60.0), (("1", "1", "98", "2"), None),
        (("1", "1", "5", None), None)], "DWA03")


def test_sanitation_and_electricity(spark):
    services(spark, I.sanitation, ["TOI01", "TOI05"], [
        (("11", "2"), 1), (("11", "1"), 0), (("11", None), None), (("14", None), 0),
        (("99", "2"), None), (("99", "1"), 0)], "basicSanitation")
    services(spark, I.electricity, ["LIGHT01", "LIGHT03"], [
        (("1", None), 1), (("1", "7"), 0), (("2", "1"), 0), ((None, "0"), 0), ((None, "1"), None)],
        "electricity")


def test_basic_facilities(spark):
    names = ["basicDrinkingWater", "basicSanitation", "cookingfuel", "electricity"]
    cases = [((1, 1, 1, 1), 1), ((0, None, 1, 1), 0), ((None, 1, 1, 1), None)]
    df = spark.createDataFrame([c for c, _ in cases], ", ".join(f"{n} int" for n in names))
    assert [r.basicFacilities for r in I.basic_facilities(df).collect()] == [e for _, e in cases]


def test_working_age(spark):
    got = apply(spark, lambda d: I.working_age(d, PROFILE), [{"R03": a} for a in (17, 18, None)], "workingAge")
    assert got == [(0,), (1,), (None,)]
