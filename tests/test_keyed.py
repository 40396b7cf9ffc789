"""Keyed draws: distribution, determinism, and the driver-side twin."""

import math

from pyspark.sql import functions as F

from propensity.functions.keyed import keyed_uniform, lognormal, normal, u


def test_uniform_range_and_moments(spark):
    r = spark.range(200000).select(u("id", "t").alias("x")).agg(
        F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg("x").alias("m"),
        F.variance("x").alias("v")).first()
    assert 0 < r.lo < 1e-3 and 1 - 1e-3 < r.hi < 1
    assert abs(r.m - 0.5) < 0.005 and abs(r.v - 1 / 12) < 0.002


def test_lognormal_log_moments(spark):
    r = spark.range(200000).select(F.log(lognormal("id", "a", "b", 1.75)).alias("z")).agg(
        F.avg("z").alias("m"), F.stddev("z").alias("s")).first()
    assert abs(r.m) < 0.02 and abs(r.s - 1.75) < 0.02


def test_normal_is_deterministic_per_key(spark):
    a = spark.range(1000).select("id", normal("id", "a", "b").alias("z"))
    b = spark.range(1000).repartition(7).select("id", normal("id", "a", "b").alias("z"))
    assert a.exceptAll(b).count() == 0


def test_driver_twin_matches_column(spark):
    got = [r.x for r in spark.range(5).select(u("id", "s").alias("x")).orderBy("id").collect()]
    assert got == [keyed_uniform(i, "s") for i in range(5)]
