"""Plan shape: operators stay in the JVM and never funnel rows into one task."""

import re

import pytest

from propensity.functions.encode import encode, factor_codes
from propensity.operators import features, profile, sampling
from propensity.sources.fixture import prospects
from conftest import SF001

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin",
             "MapInPandas", "FlatMapGroupsInPandas")
#: Operators that reduce Arrow batches with numpy by design; all others stay in the JVM.
ON_ARROW = {"corr"}


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def single_partition_inputs(plan: str) -> list[str]:
    """Operators feeding a SinglePartition exchange, other than partial aggregates."""
    lines = plan.split("\n")
    bad = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line and i + 1 < len(lines):
            nxt = lines[i + 1]
            if "HashAggregate" not in nxt and "ObjectHashAggregate" not in nxt and "QueryStage" not in nxt:
                bad.append(nxt.strip())
    return bad


@pytest.fixture(scope="module")
def base(spark):
    return features.prepare(prospects(spark, SF001))


@pytest.mark.parametrize("name", ["region", "shares", "shares_r", "corr", "describe", "poisson",
                                  "stratified", "split", "encode", "factors", "hist", "box",
                                  "rebalance", "sample"])
def test_operator_plans(spark, base, name):
    build = {
        "region": lambda: profile.region_opportunity(base),
        "shares": lambda: profile.category_share(base),
        "shares_r": lambda: profile.category_share(base, mode="fraction2"),
        "split": lambda: sampling.split(base),
        "factors": lambda: factor_codes(base, ["Gender", "Vehicle_Age", "Vehicle_Damage"]),
        "sample": lambda: sampling.sample_n(base, 100),
        "corr": lambda: profile.correlation_long(base),
        "describe": lambda: profile.describe_numeric(base),
        "poisson": lambda: sampling.rebalance_poisson(base),
        "stratified": lambda: sampling.stratified_split(base),
        "encode": lambda: encode(base),
        "hist": lambda: profile.histogram_by(base, "Age"),
        "box": lambda: profile.box_by(base, "Claims_Amount"),
        "rebalance": lambda: sampling.rebalance(base),
    }[name]
    plan = final_plan(build())
    for f in FORBIDDEN:
        assert f not in plan, f"{name}: {f}"
    assert ("MapInArrow" in plan) == (name in ON_ARROW), name
    assert not single_partition_inputs(plan), name


def test_region_aggregates_partially_before_shuffle(base):
    plan = final_plan(profile.region_opportunity(base))
    assert re.search(r"partial_count", plan) and re.search(r"partial_sum", plan)


def test_fixture_join_not_hinted(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(prospects(spark, SF001))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def written_bytes(spark, build) -> int:
    """Bytes that an operator leaves under the scratch folder."""
    import os
    from propensity.session import scratch_path
    root = scratch_path(spark, "").replace("file:", "")
    size = lambda: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(root) for f in fs)
    before = size()
    build().write.format("noop").mode("overwrite").save()
    return size() - before


def test_box_and_poisson_write_no_rows(spark):
    import os
    from propensity.operators.sampling import materialize
    rows = materialize(spark.range(0, 1_000_000, numPartitions=4).selectExpr(
        "id", "cast(id % 10 = 0 as int) as Response", "cast(xxhash64(id) % 100000 as double) / 7 as x"), "plan-rows")
    data = sum(os.path.getsize(f.removeprefix("file://")) for f in rows.inputFiles())
    assert written_bytes(spark, lambda: profile.box_by(rows, "x")) < data / 8
    assert written_bytes(spark, lambda: sampling.rebalance_poisson(rows)) < data / 8
