"""Category columns of many values."""

from pyspark.sql import functions as F

from devicelife.operators.resample import one_hot, one_hot_long


def test_more_than_a_thousand_values(spark):
    df = spark.range(1201).select("id", F.when(F.col("id") < 1200, F.concat(F.lit("v"), F.col("id"))).alias("c"))
    out, names = one_hot(df, ["c"])
    assert len(names) == 1200 and set(out.columns) == {"id", *names}
    assert out.where("id = 1100").first()["c_v1100"] == 1


def test_long_form(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 6), (3, "b", None)], "id long, c string, n int")
    got = {tuple(r) for r in one_hot_long(df, "id", ["c", "n"]).collect()}
    assert got == {(1, "c", "a"), (1, "n", "5"), (2, "n", "6"), (3, "c", "b")}
