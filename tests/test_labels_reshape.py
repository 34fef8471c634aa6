from pyspark.sql import functions as F

from surveyspark.functions import labels as L
from surveyspark.functions import reshape as R


def labelled_df(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (None,)], "v int")
    return df.select(L.labelled(F.col("v"), "v", {0: "No", 1: "It's \\ yes"}, "Answer"))


def test_labels_survive_verbs_and_parquet(spark, tmp_path):
    df = labelled_df(spark)
    df.write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t")).filter("v is not null").withColumnRenamed("v", "w")
    assert L.value_labels(back, "w") == {"0": "No", "1": "It's \\ yes"}
    assert L.variable_label(back, "w") == "Answer"


def test_decode_keeps_unlabelled_codes(spark):
    out = L.decode(labelled_df(spark))
    assert [r.v for r in out.collect()] == ["No", "It's \\ yes", "7", None]
    assert L.level_order(out, "v") == ["No", "It's \\ yes"]


def test_decode_from_a_table(spark):
    table = spark.createDataFrame([("IRN", "Iran"), ("IRN", "Islamic Republic"), ("UKR", "Ukraine")], "iso string, name string")
    df = spark.createDataFrame([("IRN", "UKR", 1), ("XX", None, 2), ("99", "IRN", 3)], "a string, b string, name int")
    df = df.select(L.labelled(F.col("a"), "a", None, "Origin"), "b", "name")
    out = L.decode_from(df, ["a", "b"], table, "iso", "name", {"99": "Unknown"})
    assert out.columns == df.columns and L.variable_label(out, "a") == "Origin"
    assert sorted(map(tuple, out.collect()), key=lambda r: r[2]) == [
        ("Iran", "Ukraine", 1), ("XX", None, 2), ("Unknown", "Iran", 3)]


def test_attach(spark):
    df = L.attach(spark.range(2).withColumn("x", F.lit(1)), "id", {0: "zero"}, "Id")
    assert df.columns == ["id", "x"] and L.value_labels(df, "id") == {"0": "zero"}


def test_column_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, `%_c` int")
    assert R.column_range(df, "a", "b") == ["a", "b"]
    assert R.any_of(df, ["b", "zz", "a"]) == ["b", "a"]
    assert R.only_in_right(df.select("a"), df) == ["b", "%_c"]
    assert R.strip_from_names(df, "%_").columns == ["a", "b", "c"]


def test_wider_names_value_level(spark):
    df = spark.createDataFrame([("x", "F", 1, 0.5), ("x", "M", 2, 0.25)], "k string, s string, n int, p double")
    wide = R.wider(df, ["k"], "s", ["F", "M", "U"], {"n_{}": F.first("n"), "%_{}": F.first("p")})
    assert wide.columns == ["k", "n_F", "%_F", "n_M", "%_M", "n_U", "%_U"]
    assert tuple(wide.first()) == ("x", 1, 0.5, 2, 0.25, None, None)


def test_longer_keeps_missing(spark):
    df = spark.createDataFrame([("x", 1, None)], "k string, a int, b int")
    got = sorted(tuple(r) for r in R.longer(df, ["k"], ["a", "b"], "name", "value").collect())
    assert got == [("x", "a", 1), ("x", "b", None)]


def test_stack_fills_missing_columns(spark):
    a = spark.createDataFrame([(1,)], "a int")
    b = spark.createDataFrame([(2,)], "b int")
    assert sorted(map(tuple, R.stack_tables([a, b]).collect()), key=str) == [(1, None), (None, 2)]
