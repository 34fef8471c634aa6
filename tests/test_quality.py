import numpy as np
import pytest
from pyspark.sql import functions as F

from surveyspark.operators.design import equal_probability
from surveyspark.operators.estimate import Breakdown
from surveyspark.operators.quality import POINTS, column_summary
from surveyspark.plans import report


@pytest.mark.parametrize("n, values", [(1, 5), (2, 9), (7, 3), (100, 40), (1001, 10**6)])
def test_summary_is_exact(spark, n, values):
    r = np.random.default_rng(n)
    a = r.integers(-values, values, n) / 4
    rows = [(float(v),) for v in a] + [(None,)] * 3
    df = spark.createDataFrame(rows, "x double").withColumn("y", F.col("x").cast("int")).repartition(7)
    got = {g.variable: g for g in column_summary(df, ["x", "y"]).collect()}
    for name, v in (("x", a), ("y", np.trunc(a))):
        g = got[name]
        assert (g.n_rows, g.n_missing) == (n + 3, 3)
        assert [g[p] for p in POINTS] == pytest.approx(np.quantile(v, list(POINTS.values())))
        assert g["mean"] == pytest.approx(v.mean())


def test_summary_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    x, y = sorted(column_summary(df, ["x", "y"]).collect(), key=lambda r: r.variable)
    assert (x.n_rows, x.n_missing, x["median"], x["mean"]) == (1, 1, None, None)
    assert (y["min"], y["median"], y["max"]) == (1.0, 1.0, 1.0)
    assert column_summary(df.filter("false"), ["x"]).collect() == []


def test_no_task_holds_all_values(spark):
    """A million different values: numbered are those of the ranges with a wanted rank only."""
    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("x"))
    out = column_summary(df, ["x"])
    row = out.first()
    values = np.sort(np.arange(1_000_000) * 7919 % 1_000_003)
    assert [row[p] for p in POINTS] == np.quantile(values, list(POINTS.values())).tolist()
    assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_breakdowns_that_share_a_level(spark):
    df = spark.createDataFrame(
        [(1, "yes", "F", "Unknown"), (2, "no", "Unknown", "old"), (3, "yes", "F", "old"), (4, "yes", "Unknown", "Unknown")],
        "id int, x string, sex string, age string")
    by = [Breakdown("sex", ("F", "Unknown")), Breakdown("age", ("old", "Unknown"))]
    for table in (report.indicator_table, report.joined_table):
        rows = {r.Answers: r for r in table(equal_probability(df), "x", by).collect()}
        assert (rows["yes"]["Unknown (sex)"], rows["yes"]["Unknown (age)"], rows["yes"].F) == (0.5, 1.0, 1.0)
        base = rows[report.UNWEIGHTED_BASE]
        assert (base.Total, base["Unknown (sex)"], base["Unknown (age)"], base.old) == (4, 2, 2, 2)
