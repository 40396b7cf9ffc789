import pytest
from pyspark.sql import functions as F

from propensity.functions.encode import encode, factor_codes, pack


def test_encode_prefix_and_inplace(spark):
    df = spark.createDataFrame([("Male", "> 2 Years", "Yes")], "Gender string, Vehicle_Age string, Vehicle_Damage string")
    r = encode(df).first()
    assert (r.x_Gender, r.x_Vehicle_Age, r.x_Vehicle_Damage) == (0, 2, 1)
    r2 = encode(df, prefix="").first()
    assert (r2.Gender, r2.Vehicle_Age, r2.Vehicle_Damage) == (0, 2, 1)


def test_encode_unseen_raises_or_nulls(spark):
    df = spark.createDataFrame([("X", "< 1 Year", "No")], "Gender string, Vehicle_Age string, Vehicle_Damage string")
    with pytest.raises(Exception, match="unseen value for Gender"):
        encode(df).collect()
    assert encode(df, on_unseen="null").first().x_Gender is None


def test_factor_codes_alphabetical(spark):
    df = spark.createDataFrame([("< 1 Year",), ("1-2 Year",), ("> 2 Years",), (None,)], "v string")
    out = {r.k: r.v for r in factor_codes(df.withColumn("k", F.col("v")), ["v"]).collect()}
    assert out == {"1-2 Year": 1, "< 1 Year": 2, "> 2 Years": 3, None: None}


def test_pack_struct(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert pack(df, ["a", "b"]).first().features == (1, 2.0)


def test_factor_codes_many_levels(spark):
    df = spark.range(0, 30_000).select(F.format_string("v%06d", 29_999 - F.col("id")).alias("v"), "id")
    out = factor_codes(df, ["v"])
    assert out.columns == ["v", "id"]
    assert out.where(F.col("v") != 30_000 - F.col("id")).count() == 0 and out.count() == 30_000
