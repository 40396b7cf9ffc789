"""Exploration operators on literal frames and on the fixture."""

import pytest
from pyspark.sql import functions as F

from propensity.operators import profile


def test_premium_filter_drops_null(spark):
    df = spark.createDataFrame([(600.0, 30), (None, 40), (100.0, 50)], "Annual_Premium double, Age int")
    assert profile.premium_by_age(df).collect() == [(600.0, 30)]


def test_numeric_columns_excludes(prepared01):
    assert profile.numeric_columns(prepared01) == ["Age", "Annual_Premium", "Vintage", "Claims_Amount",
                                                   "Claims_Num"]


def test_describe_typed(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "a double")
    r = profile.describe_numeric(df, ["a"]).first()
    assert (r.feature, r["count"], r.mean, r.stddev, r["min"], r["max"]) == ("a", 3, 2.0, 1.0, 1.0, 3.0)


def test_category_share_modes(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "g string")
    pct = {r.value: (r.n, r.prc, r.label) for r in profile.category_share(df, ["g"]).collect()}
    assert pct == {"a": (2, 66.7, "66.7%"), "b": (1, 33.3, "33.3%")}
    frac = {r.value: r.prc for r in profile.category_share(df, ["g"], mode="fraction2").collect()}
    assert frac == {"a": 0.5, "b": 0.25, None: 0.25}


def test_correlation_constant_guard(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 2.0), (5.0, 3.0)], "a double, b double")
    out = {(r.col1, r.col2): r.value for r in profile.correlation_long(df, ["a", "b"]).collect()}
    assert out[("a", "b")] is None and out[("b", "a")] is None and out[("b", "b")] == 1.0


def test_histogram_hi_equals_lo(spark):
    df = spark.createDataFrame([(1, 7.0), (0, 7.0), (1, 7.0)], "Response int, x double")
    out = {(r.Response, r.bin): r.n for r in profile.histogram_by(df, "x").collect()}
    assert out == {(1, 0): 2, (0, 0): 1}


def test_histogram_last_bin_holds_max(spark):
    df = spark.createDataFrame([(0, float(v)) for v in range(31)], "Response int, x double")
    out = {r.bin: r.n for r in profile.histogram_by(df, "x", bins=30).collect()}
    assert out[29] == 2 and sum(out.values()) == 31


def test_box_matches_interpolated_quantiles(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([(0, v) for v in vals], "Response int, x double")
    r = profile.box_by(df, "x").first()
    assert (r.q1, r.median, r.q3, r.n, r.outliers) == (2.0, 3.0, 4.0, 5, 1)
    assert (r.whisker_low, r.whisker_high) == (1.0, 4.0)


def test_region_bubble_null_log(spark):
    df = spark.createDataFrame([(1.0, 3, 10.0, 0), (2.0, 4, 20.0, 100)],
                               "region_code double, region_prospects long, total_annual_premium double, "
                               "total_claims_count long")
    out = {r.region_code: r.log10_claims_count for r in profile.region_bubble(df).collect()}
    assert out == {1.0: None, 2.0: 2.0}


def test_class_balance_counts_non_null_key(spark):
    df = spark.createDataFrame([(1, 0), (None, 0), (3, 1)], "id long, Response int")
    py = {r.Response: r.n for r in profile.class_balance(df).collect()}
    rr = {r.Response: r.n for r in profile.class_balance(df, key=None).collect()}
    assert py == {0: 1, 1: 1} and rr == {0: 2, 1: 1}


def test_region_plan_prunes_columns(prepared01):
    plan = profile.regions_ranked(profile.region_opportunity(prepared01))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "Region_Code" in plan and "Vintage" not in plan


def test_describe_all_includes_strings(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "g string, x double")
    rows = {r.summary: (r.g, r.x) for r in profile.describe_all(df).collect()}
    assert rows["count"] == ("2", "2") and rows["min"] == ("a", "1.0") and rows["max"] == ("b", "3.0")


def test_correlation_with_factor_codes(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0)], "g string, x double")
    out = {(r.col1, r.col2): r.value for r in profile.correlation_long(df, factors=True).collect()}
    assert abs(out[("g", "x")] - 1.0) < 1e-12 and abs(out[("x", "g")] - 1.0) < 1e-12


def test_correlation_pairwise_with_nulls_matches_pandas(spark):
    import pandas as pd
    rows = [(1.0, 2.0, None), (2.0, 1.0, 3.0), (3.0, 5.0, 1.0), (4.0, None, 2.0), (5.0, 4.0, 7.0), (6.0, 7.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col1, r.col2): r.value for r in profile.correlation_long(df).collect()}
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for (a, b), v in got.items():
        assert abs(v - want.loc[a, b]) < 1e-12


def test_correlation_complete_matches_pandas(spark):
    import pandas as pd
    rows = [(float(i), float((i * 7) % 11), float(i * i % 13)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.col1, r.col2): r.value for r in profile.correlation_long(df).collect()}
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    for (a, b), v in got.items():
        assert abs(v - want.loc[a, b]) < 1e-12


def test_correlation_nan_and_constant(spark):
    import math
    rows = [(1.0, 5.0, 2.0), (float("nan"), 5.0, 9.0), (3.0, 5.0, None), (4.0, 5.0, 1.0), (7.0, 5.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(4)
    got = {(r.col1, r.col2): r.value for r in profile.correlation_long(df).collect()}
    import pandas as pd
    want = pd.DataFrame(rows, columns=["a", "b", "c"]).corr()
    assert got["b", "b"] is None and got["a", "b"] is None and got["c", "b"] is None
    assert math.isclose(got["a", "c"], want.loc["a", "c"]) and got["a", "a"] == 1.0


def test_correlation_reads_the_table_once(spark):
    df = spark.range(0, 1000).select(*[(F.col("id") * (k + 3) % 97).cast("double").alias(f"c{k}") for k in range(30)])
    plan = profile.correlation_long(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_numeric_summary_missing_small_and_large(spark):
    rows = [(float("nan"), 1e-8, 2e33), (2.0, 3e-8, 4e33), (None, 2e-8, 6e33)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {r.feature: r for r in profile.describe_numeric(df).collect()}
    assert got["a"]["count"] == 1 and got["a"]["mean"] == 2.0
    assert abs(got["b"]["mean"] - 2e-8) < 1e-20 and abs(got["c"]["mean"] - 4e33) < 1e19


def test_exact_mean(spark):
    from propensity.functions.exact import exact_mean
    rows = [(float("nan"), 1e-8, 2e33, 0.1), (2.0, 3e-8, 2e33, 0.2)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    r = df.agg(*[exact_mean(c).alias(c) for c in "abcd"]).first()
    assert r.a == 2.0 and abs(r.b - 2e-8) < 1e-20 and r.c == 2e33 and abs(r.d - 0.15) < 1e-15
    assert df.limit(0).agg(exact_mean("a").alias("m")).first().m is None
