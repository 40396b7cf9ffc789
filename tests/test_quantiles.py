"""Exact order statistics against sorting."""

import math
import random
import struct

from pyspark.sql import functions as F

from propensity.operators import profile, quantiles


def test_bits_order_like_doubles(spark):
    rng = random.Random(1)
    vals = [0.0, -0.0, 1.0, -1.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
            1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, math.nan, 0.1, 1 / 3]
    vals += [s * math.ldexp(m, e) for e in range(-1022, 1024) for s, m in ((1, 1.0), (-1, 1.0), (1, 1.9999999999999998))]
    vals += [math.nextafter(2.0 ** e, 0) for e in range(-60, 60)]
    vals += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {struct.pack("<d", r.x): r.k for r in df.select("x", quantiles.ordered_bits(F.col("x")).alias("k")).collect()}
    for raw, k in got.items():
        v = struct.unpack("<d", raw)[0]
        if math.isnan(v):
            assert k == (1 << 63) - 1
        elif v == 0:
            assert k == 0
        else:
            bits = struct.unpack("<q", struct.pack("<d", abs(v)))[0]
            assert k == (bits if v > 0 else -bits), v


def test_order_values_equal_a_sort(spark):
    rng = random.Random(2)
    rows = [("a", rng.lognormvariate(0, 3)) for _ in range(2000)] + [("b", float(rng.randint(-5, 5))) for _ in range(900)]
    rows += [("c", 7.25)] * 500 + [("c", 7.250000000000001)] * 3 + [("d", -1e300), ("d", 1e-300)]
    ranks = lambda t: t.select("_g", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)).alias("_rank"))
    df = spark.createDataFrame(rows, "_g string, _x double")
    got = {(r._g, r._rank): r._x for r in quantiles.order_values(df, ranks).collect()}
    want = {}
    for g in "abcd":
        for i, v in enumerate(sorted(x for k, x in rows if k == g)):
            want[(g, i)] = v
    assert got == want


def test_box_edges(spark):
    empty = spark.createDataFrame([], "Response int, x double")
    assert profile.box_by(empty, "x").collect() == []
    rows = [(None, 1.0), (None, 2.0), (1, None), (0, 5.0), (1, 3.0), (1, 4.0), (1, 100.0)]
    got = {r.Response: r for r in profile.box_by(spark.createDataFrame(rows, "Response int, x double"), "x").collect()}
    assert (got[None].n, got[None].median, got[0].q1, got[0].whisker_high) == (2, 1.5, 5.0, 5.0)
    assert (got[1].median, got[1].n, got[1].max) == (4.0, 3, 100.0)


def test_no_join_tests_the_image_for_null(spark):
    """the image of a value is not nullable, so no pass over the rows evaluates it twice."""
    df = spark.createDataFrame([("a", 1.5), ("a", 2.5)], "_g string, _x double")
    seen = []

    def wanted(t):
        seen.append(t)
        return t.select("_g", F.lit(1).cast("long").alias("_rank"))
    got = quantiles.order_values(df, wanted)
    assert [(r["_g"], r["_x"]) for r in got.collect()] == [("a", 2.5)]
    keyed = []
    whole = quantiles._counted
    try:
        quantiles._counted = lambda k, *rest: keyed.append(k) or whole(k, *rest)
        quantiles.order_values(df, wanted)
    finally:
        quantiles._counted = whole
    assert keyed and not any(k.schema["_k"].nullable for k in keyed)
