import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from surveyspark.functions import stats
from surveyspark.operators import estimate as E
from surveyspark.operators.design import SurveyDesign, calibration, equal_probability, poststratify
from surveyspark.operators.estimate import Breakdown, Question, estimate, estimate_many, with_limits

BY = (Breakdown("sex", ("F", "M")), Breakdown("age", ("young", "old")))


def sample(seed=7, n=400, giant=False):
    """Clustered rows; with ``giant`` a third of them share one cluster."""
    r = np.random.default_rng(seed)
    psu = r.integers(0, 60, n)
    if giant:
        psu[: n // 3] = 0
    return pd.DataFrame({
        "id": np.arange(n), "psu": psu, "w0": r.uniform(1, 5, n).round(3),
        "h": r.choice(["a", "b", "c"], n), "sex": r.choice(["F", "M"], n),
        "age": r.choice(["young", "old", "unknown"], n),
        "x": r.choice(["no", "yes"], n, p=[0.7, 0.3]), "x3": r.choice(["p", "q", "r"], n),
        "inside": r.random(n) < 0.8, "missing": r.random(n) < 0.1,
        "fraction": 0.25, "population": 5000.0,
    })


def brute(df, x, psu, weight, stratum=None, domain=None, stat="proportion", f=0.0, df_from="design"):
    """One cell at a time, one row at a time."""
    inside = ~df["missing"] if domain is None else ~df["missing"] & df[domain]
    out = {}
    groups = [("Total", "Total", np.ones(len(df), bool))]
    groups += [("sex", v, (df["sex"] == v).values) for v in ("F", "M")]
    groups += [("age", v, (df["age"] == v).values) for v in ("young", "old")]
    w = df[weight].values
    for by, level, member in groups:
        g = member & inside.values
        for k in sorted(df.loc[inside, x].unique()):
            hit = (df[x] == k).values & g
            if not hit.any():
                continue
            base, total = w[g].sum(), w[hit].sum()
            p = total / base
            z = np.where(g, (hit - p) / base, 0.0) if stat == "proportion" else hit.astype(float)
            if stratum:
                z = z.copy()
                for h in df[stratum].unique():
                    s = (df[stratum] == h).values
                    z[s] = z[s] - (w[s] * z[s]).sum() / w[s].sum()
            e = pd.Series(w * z).groupby(df[psu].values).sum()
            m = len(e)
            v = (1 - f) * m / (m - 1) * ((e - e.mean()) ** 2).sum()
            seen = df.loc[g if df_from == "group" else inside, psu].nunique()
            out[by, level, k] = (total, int(hit.sum()), p, math.sqrt(v), seen - 1)
    return out


def got_cells(cells):
    return {(r.breakdown, r.level, r.answer): (r.n, r.unwn, r.p, r.se, r.df) for r in cells.collect()}


def check(got, want):
    assert got.keys() == want.keys()
    for key, row in want.items():
        assert got[key] == pytest.approx(row, rel=1e-9, abs=1e-12), key


def design_of(spark, pdf, clustered, stratified, fpc):
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.col("missing"), F.col("x"))).withColumn(
        "x3", F.when(~F.col("missing"), F.col("x3")))
    design = SurveyDesign(df, weight="w0", psu="psu" if clustered else None)
    f = 0.0
    if fpc == "fraction":
        design, f = design.replace(fpc="fraction", fpc_kind="fraction"), 0.25
    if fpc == "size":
        units = pdf["psu"].nunique() if clustered else len(pdf)
        design, f = design.replace(fpc="population", fpc_kind="size"), units / 5000.0
    pdf = pdf.copy()
    weight = "w0"
    if stratified:
        margin = pd.DataFrame({"h": ["a", "b", "c"], "Freq": [300, 500, 200]})
        design = poststratify(design, "h", spark.createDataFrame(margin))
        sums = pdf.groupby("h")["w0"].transform("sum")
        pdf["wps"] = pdf["w0"] * pdf["h"].map(dict(zip(margin.h, margin.Freq))) / sums
        weight = "wps"
    return design, pdf, weight, f


@pytest.mark.parametrize("clustered, stratified, fpc, x, stat", [
    (True, True, "fraction", "x", "proportion"),
    (True, True, None, "x3", "proportion"),
    (True, False, "size", "x3", "proportion"),
    (True, True, "fraction", "x", "total"),
    (False, True, "size", "x", "proportion"),
    (False, False, None, "x3", "proportion"),
    (False, True, "size", "x3", "total"),
])
def test_against_brute_force(spark, clustered, stratified, fpc, x, stat):
    pdf = sample()
    design, pdf, weight, f = design_of(spark, pdf, clustered, stratified, fpc)
    psu = "psu" if clustered else "id"
    want = brute(pdf, x, psu, weight, "h" if stratified else None, "inside", stat, f)
    check(got_cells(estimate(design.filter("inside"), x, BY, stat)), want)


def test_giant_cluster(spark):
    design, pdf, weight, f = design_of(spark, sample(giant=True, n=900), True, True, None)
    check(got_cells(estimate(design, "x", BY)), brute(pdf, "x", "psu", weight, "h"))


@pytest.mark.parametrize("df_from", ["design", "group"])
def test_crowded_units_beside_others(spark, monkeypatch, df_from):
    monkeypatch.setattr(E, "CROWD", 20)
    monkeypatch.setattr(E, "UNIT_ROWS", 100)
    design, pdf, weight, f = design_of(spark, sample(giant=True, n=900), True, True, None)
    want = brute(pdf, "x3", "psu", weight, "h", "inside", df_from=df_from)
    check(got_cells(estimate(design.filter("inside"), "x3", BY, df_from=df_from)), want)


def test_sums_of_units_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(E, "UNIT_ROWS", 100)
    design, _, _, _ = design_of(spark, sample(), True, True, None)
    cells = estimate_many(design, [Question("x"), Question("x3")], BY)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(_psu#\d+L?, \d+\)", plan)
    assert not re.search(r"hashpartitioning\(_psu#\d+L?, _tab", plan)


def test_numbers_in_words(spark):
    sizes = [3, 10**9, 1, 10**9, 7, 10**15, 2]
    rows = [[0] * 7, [s - 1 for s in sizes], [1, 5, 0, 123456789, 6, 10**14 + 1, 1]]
    df = spark.createDataFrame(rows, ", ".join(f"v{i} long" for i in range(7)))
    words, read = E._packed({f"v{i}": (F.col(f"v{i}"), s) for i, s in enumerate(sizes) if s < 2**31})
    assert len(words) == 2
    back = df.select("v5", *[c.alias(n) for n, c in words.items()]).select(*[c.alias(n) for n, c in read.items()])
    assert [list(r) for r in back.collect()] == [[v for v, s in zip(r, sizes) if s < 2**31] for r in rows]


def test_no_rows_no_cells(spark):
    design, _, _, _ = design_of(spark, sample(), True, False, None)
    assert estimate(design.replace(df=design.df.filter("false")), "x", BY).collect() == []


@pytest.mark.parametrize("clustered", [True, False])
def test_degrees_of_freedom_by_group(spark, clustered):
    design, pdf, weight, f = design_of(spark, sample(), clustered, True, None)
    psu = "psu" if clustered else "id"
    want = brute(pdf, "x", psu, weight, "h", df_from="group")
    check(got_cells(estimate(design, "x", BY, df_from="group")), want)


def test_many_tables_equal_single_ones(spark):
    design, _, _, _ = design_of(spark, sample(), True, True, "fraction")
    both = estimate_many(design, [Question("x", "inside"), Question("x3")], BY)
    check(got_cells(both.filter("tab = 1")), got_cells(estimate(design.filter("inside"), "x", BY)))
    check(got_cells(both.filter("tab = 2")), got_cells(estimate(design, "x3", BY)))


def test_a_lookup_over_the_broadcast_threshold_is_shuffled(spark):
    design, pdf, weight, f = design_of(spark, sample(), True, True, None)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = estimate(design, "x3", BY)
        assert "Broadcast" not in cells._jdf.queryExecution().executedPlan().toString()
        check(got_cells(cells), brute(pdf, "x3", "psu", weight, "h"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_question_without_answers_beside_others(spark):
    design, _, _, _ = design_of(spark, sample(), True, True, None)
    both = estimate_many(design, [Question("x3", "false"), Question("x")], BY)
    assert both.filter("tab = 1").count() == 0
    check(got_cells(both.filter("tab = 2")), got_cells(estimate(design, "x", BY)))


def test_shares_add_up_and_calibration_holds(spark):
    design, _, _, _ = design_of(spark, sample(), True, True, None)
    cells = estimate(design, "x3", BY)
    sums = cells.groupBy("breakdown", "level").agg(F.sum("p").alias("p")).collect()
    assert all(r.p == pytest.approx(1) for r in sums)
    margin = spark.createDataFrame([("a", 300), ("b", 500), ("c", 200)], "h string, Freq long")
    assert all(r.matches for r in calibration(design, margin).collect())


@pytest.mark.parametrize("margin", [
    [("a", 300), ("b", 500)], [("a", 300), ("b", 500), ("c", 200), ("d", 100)]])
def test_unmatched_strata_fail(spark, margin):
    df = spark.createDataFrame(sample())
    target = spark.createDataFrame(margin, "h string, Freq long")
    with pytest.raises(Exception, match="post-stratum"):
        poststratify(SurveyDesign(df, "w0"), "h", target).df.collect()


def test_one_unit_has_no_variance(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "psu int, x string")
    got = estimate(equal_probability(df, psu="psu"), "x").collect()
    assert [r.se for r in got] == [None, None] and {r.p for r in got} == {0.5}


def test_no_rows_in_domain(spark):
    df = spark.createDataFrame([(1, "a")], "psu int, x string")
    assert estimate(equal_probability(df).filter("psu > 5"), "x").collect() == []


@pytest.mark.parametrize("df, value", [
    (1, 12.7062047364), (2, 4.3026527297), (5, 2.5705818366), (30, 2.0422724563), (338, 1.9670073)])
def test_t_quantile(spark, df, value):
    assert stats.t_quantile_975(df) == pytest.approx(value, abs=1e-7)
    got = spark.range(1).select(stats.t_975(F.lit(df).cast("bigint")).alias("t")).first().t
    assert got == pytest.approx(value, abs=1e-7)


def test_series_meets_table(spark):
    got = spark.range(1).select(stats.t_975(F.lit(201)).alias("t")).first().t
    assert got == pytest.approx(stats.t_quantile_975(201), abs=1e-10)


def test_limits(spark):
    cells = spark.createDataFrame([(0.2, 0.05, 50), (1.0, 0.0, 50)], "p double, se double, df bigint")
    a, b = with_limits(cells).collect()
    t = stats.t_quantile_975(50)
    mid, half = math.log(0.25), t * 0.05 / 0.16
    assert a.low == pytest.approx(1 / (1 + math.exp(-(mid - half))))
    assert a.upp == pytest.approx(1 / (1 + math.exp(-(mid + half))))
    assert (b.low, b.upp) == (1.0, 1.0)
    plain = with_limits(cells, "mean").first()
    assert plain.low == pytest.approx(0.2 - t * 0.05)
