import pytest
from pyspark.sql import functions as F

from surveyspark.functions import nulls as N


def one(spark, schema, row, column):
    return spark.createDataFrame([row], schema).select(column.alias("v")).first()["v"]


def test_in_set_is_false_for_missing(rows):
    got = rows("a string", [("1",), (None,), ("9",)],
               {"x": N.in_set("a", ["1"]), "y": ~N.in_set("a", ["1"])})
    assert got == [(True, False), (False, True), (False, True)]


def test_strict_and_skipping_sums(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), ("b", 0)], "g string, v int")
    got = {r.g: (r.s, r.k) for r in df.groupBy("g").agg(
        N.strict_sum(F.col("v") == 1).alias("s"), N.skip_sum(F.col("v") == 1).alias("k")).collect()}
    assert got == {"a": (None, 1), "b": (1, 1)}


def test_sums_of_nothing_are_zero(spark):
    df = spark.createDataFrame([(None, None)], "a int, b int")
    assert df.agg(N.sum_or_zero("a").alias("v")).first().v == 0
    assert df.select(N.row_sum(["a", "b"]).alias("v")).first().v == 0


def test_unite_spells_missing_parts(spark):
    assert one(spark, "a int, b int", (5, None), N.unite("a", "b")) == "5_NA"


def test_if_else_stays_missing(rows):
    got = rows("a int", [(1,), (0,), (None,)], {"v": N.if_else_na(F.col("a") == 1, "y", "n")})
    assert [r[0] for r in got] == ["y", "n", None]


@pytest.mark.parametrize("age, band", [
    (4, 1), (5, 2), (11, 2), (12, 3), (17, 3), (18, 4), (24, 4), (25, 5), (49, 5), (50, 6),
    (59, 6), (60, 7), (-1, None), (None, None)])
def test_cut_is_right_closed(spark, age, band):
    cut = N.cut("a", (-1, 4, 11, 17, 24, 49, 59), list(range(1, 8)))
    assert one(spark, "a int", (age,), cut) == band


def test_ratio_by_zero_is_missing(spark):
    assert one(spark, "a int, b int", (1, 0), N.ratio("a", "b")) is None


def test_kleene_any(rows):
    got = rows("a string, b string", [("4", None), ("1", None), ("1", "1")],
               {"v": N.any_equal(["a", "b"], "4")})
    assert [r[0] for r in got] == [True, None, False]


def test_recode_and_number(rows):
    got = rows("a string", [("1",), ("97",), ("x",), (None,)],
               {"r": N.recode("a", {"1": 10, "97": 20}), "n": N.number("a")})
    assert got == [(10, 1.0), (20, 97.0), (None, None), (None, None)]
