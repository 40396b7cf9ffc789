"""Fixture and feature synthesis: verified values and invariants."""

from pyspark.sql import functions as F

from conftest import SF001, SF01
from propensity.operators import features, profile
from propensity.plans.registry import prepared
from propensity.sources.fixture import prospects


def test_prospects_shape(spark):
    df = prospects(spark, SF001)
    assert df.count() == 1500
    assert df.columns[:3] == ["id", "Gender", "Age"]


def test_prepared_verified_values_sf001(spark):
    r = prepared(spark, SF001).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Response") == 1).alias("pos"),
        F.count_if(F.col("Claims_Amount") == 0).alias("zeros"), F.max("Claims_Amount").alias("mx"),
        F.min(F.when(F.col("Claims_Amount") > 0, F.col("Claims_Amount"))).alias("mnz"),
        F.max("Claims_Num").alias("mxn"), F.sum("Claims_Amount").alias("sa"),
        F.sum("Claims_Num").alias("sn"), F.avg("Annual_Premium").alias("mp")).first()
    assert (r.rows, r.pos, r.zeros, r.mx, r.mnz, r.mxn) == (1500, 175, 28, 117191, 9, 7295)
    assert (r.sa, r.sn) == (2536484, 108563)
    assert abs(r.mp - 2080) < 1e-9


def test_prepared_verified_values_sf01(prepared01):
    r = prepared01.agg(F.count_if(F.col("Response") == 0).alias("neg"),
                       F.count_if(F.col("Claims_Amount") == 0).alias("zeros"),
                       F.sum("Claims_Amount").alias("sa"), F.sum("Claims_Num").alias("sn"),
                       F.max("Claims_Num").alias("mxn")).first()
    assert (r.neg, r.zeros, r.sa, r.sn, r.mxn) == (13495, 931, 10820279, 449506, 7215)


def test_claims_num_zero_iff_amount_zero(prepared01):
    bad = prepared01.where((F.col("Claims_Num") == 0) != (F.col("Claims_Amount") == 0)).count()
    assert bad == 0


def test_region_zero_sf01(prepared01):
    r = profile.region_opportunity(prepared01).where("region_code = 0").first()
    assert (r.region_prospects, r.total_claims_amount, r.total_claims_count) == (519, 316760, 12417)
    assert abs(r.total_annual_premium - 1054969.3054) < 1e-3


def test_r_variant_floor_and_int_premium(spark):
    df = prepared(spark, SF001, variant="r")
    assert dict(df.dtypes)["Annual_Premium"] == "int"
    assert df.where(F.col("Claims_Amount") == 0).count() == 0


def test_with_global_attaches_scalars(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0)], "id long, x double")
    out = features.with_global(df, mx=F.max("x"), mn=F.min("x")).orderBy("id").collect()
    assert [(r.mx, r.mn) for r in out] == [(4.0, 2.0), (4.0, 2.0)]


def test_normalise_mean_int(spark):
    df = spark.createDataFrame([(1, 1000.0), (2, 3000.0)], "id long, Annual_Premium double")
    out = [r.Annual_Premium for r in features.normalise_mean(df, to_int=True).orderBy("id").collect()]
    assert out == [1040, 3120]
