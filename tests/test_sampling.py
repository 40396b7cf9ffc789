"""Resampling and splitting: verified values, invariants, layout independence."""

from pyspark.sql import functions as F

from propensity.operators import sampling


def _sig(df):
    return sorted((r.Response, r.n, r.s, r.d) for r in df.groupBy("Response").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("id") * F.col("copy")).alias("s"),
        F.countDistinct("id").alias("d")).collect())


def test_rebalance_verified_sf01(prepared01):
    assert _sig(sampling.rebalance(prepared01)) == [(0, 13495, 152057821, 8517),
                                                    (1, 13495, 552865975, 1505)]


def test_rebalance_layout_independent(spark, prepared01):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = _sig(sampling.rebalance(prepared01.repartition(7)))
        spark.conf.set("spark.sql.shuffle.partitions", "17")
        b = _sig(sampling.rebalance(prepared01.repartition(2)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert a == b == [(0, 13495, 152057821, 8517), (1, 13495, 552865975, 1505)]


def test_dense_index_equals_row_number(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 5000).alias("k"))
    got = sampling.dense_index(df, ["g"], ["k"], name="i", partitions=6)
    want = df.withColumn("i", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == 5000


def test_rebalance_one_class_and_n_larger(spark):
    df = spark.createDataFrame([(i, 0) for i in range(5)], "id long, Response int")
    out = sampling.rebalance(df, n=12)
    assert out.count() == 12 and out.where("Response = 0").count() == 12


def test_expand_copies_heavy_path(spark):
    df = spark.createDataFrame([(1, 10000), (2, 3), (3, 0)], "id long, c long")
    out = sampling.expand_copies(df, "c", keys=["id"], chunk=1000)
    r = out.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.max("copy").alias("mx"),
                               F.countDistinct("copy").alias("d")).orderBy("id").collect()
    assert [(x.n, x.mx, x.d) for x in r] == [(10000, 10000, 10000), (3, 3, 3)]


def test_rebalance_refuses_repeated_keys_and_takes_composite_ones(spark):
    import pytest
    rows = [(1, 1, 0), (1, 2, 0), (2, 1, 0), (3, 1, 1)]
    df = spark.createDataFrame(rows, "id long, part int, Response int")
    with pytest.raises(ValueError, match="does not identify"):
        sampling.rebalance(df)
    out = sampling.rebalance(df, key=["id", "part"])
    assert {r.Response: r["count"] for r in out.groupBy("Response").count().collect()} == {0: 3, 1: 3}


def test_many_classes(spark):
    df = spark.range(0, 100_001).select("id", (F.col("id") * 7 % 100_001).alias("Response"))
    assert sampling.rebalance(df, n=1).count() == 100_001
    assert sampling.stratified_split(df).where("split = 'train'").count() == 100_001


def test_poisson_rebalance_sizes_near_target(prepared01):
    out = sampling.rebalance_poisson(prepared01)
    sizes = {r.Response: r["count"] for r in out.groupBy("Response").count().collect()}
    assert sizes == {0: 13427, 1: 13586}


def test_poisson_table_and_search_match_inverse_cdf(spark):
    import math
    lams = (0.5, 3.0, 40.0, 900.0)
    rows = [(lam, uu) for lam in lams for uu in (2.0 ** -53, 0.01, 0.3, 0.5, 0.9, 0.999)]
    steps = sampling.poisson_steps(spark.createDataFrame([(x, x) for x in lams], "k double, _lam double"), "k")
    cells = sampling.poisson_cells(steps, "k")
    df = spark.createDataFrame(rows, "k double, u double").withColumn(
        "_cell", F.floor(F.col("u") * sampling.DRAW_CELLS).cast("int")).join(cells, ["k", "_cell"])
    got = {(r.k, r.u): r.c for r in df.select("k", "u", (F.col("_under") + F.size(F.filter(
        "_in", lambda v: v < F.col("u")))).alias("c")).collect()}

    def inv(lam, uu):
        k, lp, cdf = 0, -lam, math.exp(-lam)
        while cdf < uu:
            k += 1
            lp += math.log(lam) - math.log(k)
            cdf += math.exp(lp)
        return k
    assert got == {(lam, uu): inv(lam, uu) for lam, uu in rows}


def test_sample_n_caps_at_population(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    assert sampling.sample_n(df, 10000).count() == 3


def test_stratified_split_verified(prepared01):
    out = sampling.stratified_split(prepared01)
    got = sorted((r.Response, r.split, r.n, r.s) for r in out.groupBy("Response", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("s")).collect())
    assert got == [(0, "test", 2699, 20177691), (0, "train", 10796, 81030909),
                   (1, "test", 301, 2190579), (1, "train", 1204, 9093321)]


def test_split_disjoint_complete(prepared01):
    s = sampling.split(prepared01)
    assert s.where(F.col("split").isNull()).count() == 0
    assert s.select("id").distinct().count() == prepared01.count()
    n_train = s.where("split = 'train'").count()
    assert 0.75 < n_train / prepared01.count() < 0.85


def test_sample_n_equals_full_sort(spark):
    df = spark.range(0, 20000).withColumnRenamed("id", "id")
    got = sampling.sample_n(df, 300)
    from propensity.functions.keyed import hash_order
    want = df.orderBy(hash_order(sampling.row_key(["id"]), "sample"), "id").limit(300)
    assert got.count() == 300 and got.exceptAll(want).count() == 0


def test_keyed_operators_layout_independent(spark, prepared01):
    from propensity.operators import profile

    def run(parts, spread):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        d = prepared01.repartition(spread)
        pois = sorted((r.Response, r.n, r.s) for r in sampling.rebalance_poisson(d).groupBy("Response").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.col("id") * F.col("copy")).alias("s")).collect())
        strat = sorted((r.Response, r.split, r.s) for r in sampling.stratified_split(d).groupBy(
            "Response", "split").agg(F.sum("id").alias("s")).collect())
        box = sorted(tuple(r) for r in profile.box_by(d, "Claims_Amount").collect())
        return pois, strat, box

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert run(3, 1) == run(11, 9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_poisson_tiny_class_heavy_split(spark):
    rows = [(i, 0) for i in range(20000)] + [(100000, 1), (100001, 1)]
    df = spark.createDataFrame(rows, "id long, Response int")
    out = sampling.rebalance_poisson(df)          # lam = 10000 for class 1
    per_id = {r.id: (r.n, r.mx) for r in out.where("Response = 1").groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.max("copy").alias("mx")).collect()}
    assert all(n == mx for n, mx in per_id.values())          # copies numbered 1..c, none lost
    total = sum(n for n, _ in per_id.values())
    assert 19000 < total < 21000                               # Poisson(10000) x 2 around 20000


def test_rebalance_keeps_majority_when_asked(prepared01):
    out = sampling.rebalance(prepared01, resample_majority=False)
    sizes = {r.Response: r["count"] for r in out.groupBy("Response").count().collect()}
    assert sizes == {0: 13495, 1: 13495}
    major = out.where("Response = 0")
    assert major.select("id").distinct().count() == 13495 and major.where("copy <> 1").count() == 0


def test_rebalance_tiny_class_heavy_copies_exact(spark):
    rows = [(i, 0) for i in range(20000)] + [(100000, 1), (100001, 1), (100002, 1)]
    df = spark.createDataFrame(rows, "id long, Response int")
    out = sampling.rebalance(df)                       # class 1: 3 rows -> 20000 draws
    sizes = {r.Response: r["count"] for r in out.groupBy("Response").count().collect()}
    assert sizes == {0: 20000, 1: 20000}
    per_id = out.where("Response = 1").groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.max("copy").alias("mx"), F.countDistinct("copy").alias("d")).collect()
    assert all(r.n == r.mx == r.d for r in per_id) and sum(r.n for r in per_id) == 20000


def test_rebalance_draws_are_never_broadcast(spark, prepared01, monkeypatch):
    """The optimizer took the draws for as small as the two class sizes; they are as many as the rows."""
    import re
    plans, write = {}, sampling.materialize
    monkeypatch.setattr(sampling, "materialize", lambda df, name: plans.setdefault(
        name, df._jdf.queryExecution().executedPlan().toString()) and write(df, name))
    sampling.rebalance(prepared01)
    joins = re.findall(r"(\w+Join) \[Response#\d+, _k#", plans["picked"])
    assert joins and set(joins) == {"SortMergeJoin"}
