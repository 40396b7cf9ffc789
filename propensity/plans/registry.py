"""Registered queries: name -> (spark builder, DuckDB oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a DataFrame over the whole
input tables; none samples, caps or filters its input to stay cheap.  Builders
that need synthesised columns stage the columns they use once; operators that
index, cut or fit run their jobs while the plan is built.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.encode import encode, factor_codes, pack
from ..operators import features, profile, sampling
from ..session import scratch_path
from ..sources import tables
from ..sources.fixture import prospects, read_input
from . import oracle_sql as O

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# What the synthesis of claims and premium itself reads.
SYNTHESIS_COLUMNS = ["id", "Response", "Annual_Premium"]


def staged_prospects(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The raw prospects (orders joined to customer), written once under the
    checkpoint folder: the preparation reads its input three times (two
    one-row aggregates and the output), and at scale each read would
    otherwise repeat the join's shuffle.  Only ``columns`` (default: all) and
    what the synthesis needs are written."""
    raw = prospects(spark, sf_dir)
    if columns is not None:
        raw = raw.select(*[c for c in raw.columns if c in {*columns, *SYNTHESIS_COLUMNS}])
    return sampling.materialize(raw, "prospects")


def prepared(spark: SparkSession, sf_dir: str, variant: str = "python",
             columns: list[str] | None = None) -> DataFrame:
    """The prepared table; with ``columns``, only those and the synthesis' own.
    Queries that use no synthesised column read ``prospects`` instead."""
    return features.prepare(staged_prospects(spark, sf_dir, columns), variant=variant)


def rebalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.rebalance(prepared(spark, sf_dir))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up with its floating sum at 4 decimals, as the SQL check has it."""
    rolled = profile.region_opportunity(prepared(spark, sf_dir, columns=["Region_Code"]))
    return rolled.withColumn("total_annual_premium", F.round("total_annual_premium", 4))


def rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    """Doubles whose last bits depend on the order of addition, at ``digits`` decimals."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


SHARE_SQL_COLS = S.SHARE_COLUMNS
NUMERIC_COLS = [f.name for f in S.BASE_SCHEMA.fields if f.dataType.simpleString() != "string"]
DESCRIBE_COLS = [c for c in NUMERIC_COLS if c not in S.DESCRIBE_EXCLUDE]
CORR_COLS = NUMERIC_COLS
FACTOR_COLS = [c for c in S.BASE_COLUMNS if c not in NUMERIC_COLS]


# --- sources, sinks, feature synthesis --------------------------------------

@register("prospects", O.RAW)
def q_prospects(spark, sf_dir):
    return prospects(spark, sf_dir)


@register("prepared", O.PREPARED)
def q_prepared(spark, sf_dir):
    return prepared(spark, sf_dir)


@register("prepared_r", O.prepared_sql("r"))
def q_prepared_r(spark, sf_dir):
    return prepared(spark, sf_dir, variant="r")


@register("csv_roundtrip", O.RAW)
def q_csv_roundtrip(spark, sf_dir):
    """The raw table written as CSV with a header, read back with the schema."""
    path = scratch_path(spark, f"raw-csv-{uuid.uuid4().hex}")
    tables.write_csv(prospects(spark, sf_dir), path)
    return tables.read_csv(spark, path)


def _scratch_table(spark, label: str) -> tuple[str, str]:
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    return name, scratch_path(spark, f"table-{name}")


def _release(spark, name: str) -> DataFrame:
    """The saved table as scanned by name; its catalog entry goes, the files
    stay under the checkpoint folder for the returned frame."""
    schema, files = tables.read_table(spark, name).schema, tables.location(spark, name)
    tables.drop_table(spark, name)
    return spark.read.schema(schema).parquet(files)


@register("table_roundtrip", O.PREPARED)
def q_table_roundtrip(spark, sf_dir):
    """A catalog table overwritten with the prepared table, then scanned by name."""
    name, path = _scratch_table(spark, "prepared")
    tables.save_table(prospects(spark, sf_dir), name, path=path)
    tables.save_table(prepared(spark, sf_dir), name, path=path)
    return _release(spark, name)


@register("preview", O.with_prepared("select * from t order by id limit 100"))
def q_preview(spark, sf_dir):
    return profile.preview(prepared(spark, sf_dir), 100, order=["id"])


# --- exploration ---------------------------------------------------------------

@register("region_opportunity", O.with_prepared(O.REGION_AGG))
def q_region_opportunity(spark, sf_dir):
    return regions(spark, sf_dir)


@register("region_view", O.with_prepared(O.REGION_AGG))
def q_region_view(spark, sf_dir):
    """The region roll-up published as a view and read through SQL; the returned
    frame holds the view's plan, so its name does not stay in the session."""
    view = f"region_rollup_{uuid.uuid4().hex[:8]}"
    tables.create_view(regions(spark, sf_dir), view)
    try:
        return spark.sql(f"SELECT * FROM {view}")
    finally:
        tables.drop_view(spark, view)


@register("regions_ranked", O.with_prepared(O.REGIONS_RANKED))
def q_regions_ranked(spark, sf_dir):
    return profile.regions_ranked(regions(spark, sf_dir))


@register("region_bubble", O.with_prepared(O.REGION_BUBBLE))
def q_region_bubble(spark, sf_dir):
    return rounded(profile.region_bubble(regions(spark, sf_dir)), 9, "log10_claims_count")


@register("premium_by_age", O.with_prepared(O.PREMIUM_BY_AGE))
def q_premium_by_age(spark, sf_dir):
    return profile.premium_by_age(prepared(spark, sf_dir, columns=["Age"]))


@register("numeric_summary", O.with_prepared(O.describe(DESCRIBE_COLS)))
def q_numeric_summary(spark, sf_dir):
    df = prepared(spark, sf_dir, columns=DESCRIBE_COLS)
    return rounded(profile.describe_numeric(df, profile.numeric_columns(df)), 6, "mean", "stddev")


@register("class_balance", O.with_prepared("select Response, count(id) as n from t group by Response"))
def q_class_balance(spark, sf_dir):
    return profile.class_balance(prospects(spark, sf_dir))


@register("quality_balance", "select quality, count(doc_id) as n from labels group by quality")
def q_quality_balance(spark, sf_dir):
    return profile.class_balance(read_input(spark, sf_dir, "labels"), "quality", "doc_id")


@register("majority_count",
          O.with_prepared("select cast(count_if(Response = 0) as bigint) as n from t"))
def q_majority_count(spark, sf_dir):
    return profile.count_where(prospects(spark, sf_dir), F.col("Response") == 0)


@register("long_form", O.with_prepared(O.long_form(SHARE_SQL_COLS)))
def q_long_form(spark, sf_dir):
    return profile.to_long(prospects(spark, sf_dir), S.SHARE_COLUMNS)


@register("category_share", O.with_prepared(O.category_share(SHARE_SQL_COLS)))
def q_category_share(spark, sf_dir):
    return profile.category_share(prospects(spark, sf_dir))


@register("category_share_r", O.with_prepared(O.category_share(SHARE_SQL_COLS, "fraction2")))
def q_category_share_r(spark, sf_dir):
    return profile.category_share(prospects(spark, sf_dir), mode="fraction2")


@register("correlation", O.with_prepared(O.correlation(CORR_COLS)))
def q_correlation(spark, sf_dir):
    return rounded(profile.correlation_long(prepared(spark, sf_dir), CORR_COLS), 2, "value")


@register("correlation_factors", O.correlation_factors(NUMERIC_COLS, FACTOR_COLS))
def q_correlation_factors(spark, sf_dir):
    """R form: text columns enter as their alphabetical codes."""
    df = sampling.materialize(prepared(spark, sf_dir), "prepared")
    return rounded(profile.correlation_long(df, factors=True), 2, "value")


@register("histogram", O.with_prepared(O.histogram("Age")))
def q_histogram(spark, sf_dir):
    return profile.histogram_by(prospects(spark, sf_dir), "Age")


@register("box_summary", O.with_prepared(O.box("Claims_Amount")))
def q_box_summary(spark, sf_dir):
    return profile.box_by(prepared(spark, sf_dir, columns=[]), "Claims_Amount")


@register("feature_by_label",
          O.with_prepared("select Age as x, cast(Response as varchar) as Response from t"))
def q_feature_by_label(spark, sf_dir):
    return profile.feature_by_label(prospects(spark, sf_dir), "Age")


# --- encoding --------------------------------------------------------------------

@register("encoded", O.with_prepared(O.ENCODED))
def q_encoded(spark, sf_dir):
    return encode(prepared(spark, sf_dir))


@register("factor_codes", O.with_prepared(O.factor_codes(["Gender", "Vehicle_Age", "Vehicle_Damage"])))
def q_factor_codes(spark, sf_dir):
    return factor_codes(prepared(spark, sf_dir), ["Gender", "Vehicle_Age", "Vehicle_Damage"])


# --- resampling and splitting --------------------------------------------------

@register("rebalance", O.REBALANCED)
def q_rebalance(spark, sf_dir):
    return rebalanced(spark, sf_dir)


@register("rebalance_poisson", O.POISSON)
def q_rebalance_poisson(spark, sf_dir):
    return sampling.rebalance_poisson(prepared(spark, sf_dir))


@register("sample_n", O.SAMPLE_N)
def q_sample_n(spark, sf_dir):
    return sampling.sample_n(rebalanced(spark, sf_dir), S.SAMPLE_ROWS, key=["id", "copy"])


@register("split_sizes", O.SPLIT_SIZES)
def q_split_sizes(spark, sf_dir):
    return sampling.split_sizes(sampling.split(rebalanced(spark, sf_dir), key=["id", "copy"]))


@register("stratified_split", O.STRATIFIED)
def q_stratified_split(spark, sf_dir):
    return sampling.stratified_split(prepared(spark, sf_dir))


@register("inference_data", O.INFERENCE_DATA)
def q_inference_data(spark, sf_dir):
    """U1 + X12: train and test encoded separately, then recombined."""
    s = sampling.split(rebalanced(spark, sf_dir), key=["id", "copy"])
    train = encode(s.where(F.col("split") == "train"))
    test = encode(s.where(F.col("split") == "test"))
    return sampling.recombine(train, test)


# --- scaling (SQL forms, oracle-checked) ----------------------------------------

def _balanced_split(spark, sf_dir):
    return sampling.split(rebalanced(spark, sf_dir), key=["id", "copy"])


def _fitting_data(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The prepared table and its balanced split, each written once: a fit, an
    evaluation and a scoring run all read them again."""
    base = sampling.materialize(prepared(spark, sf_dir), "prepared")
    data = sampling.split(sampling.rebalance(base), key=["id", "copy"])
    return base, sampling.materialize(data, "balanced-split")


@register("minmax_scaled", O.minmax_scaled(S.BASELINE_FEATURES))
def q_minmax_scaled(spark, sf_dir):
    from ..operators.models import minmax_sql
    d = _balanced_split(spark, sf_dir)
    out = minmax_sql(d.where(F.col("split") == "train"), d, S.BASELINE_FEATURES, suffix="_mm")
    return out.select("id", "copy", "split", *[f"{c}_mm" for c in S.BASELINE_FEATURES])


@register("sd_scaled", O.sd_scaled(S.BASELINE_FEATURES))
def q_sd_scaled(spark, sf_dir):
    from ..operators.models import sd_scale_sql
    d = _balanced_split(spark, sf_dir)
    out = sd_scale_sql(d.where(F.col("split") == "train"), d, S.BASELINE_FEATURES, suffix="_sd")
    scaled = [f"{c}_sd" for c in S.BASELINE_FEATURES]
    return rounded(out.select("id", "copy", "split", *scaled), 9, *scaled)


# --- models (rows-only checks: fitted models are not SQL) -----------------------

@register("baseline_scores", None)
def q_baseline_scores(spark, sf_dir):
    """M4 + M12/M14: baseline fitted on the balanced train split, then every
    row of the prepared (unbalanced) table scored."""
    from ..operators.score import score
    from .workflow import fit_baseline
    base, data = _fitting_data(spark, sf_dir)
    return score(base, fit_baseline(data)).select("id", "Response", "prediction")


@register("baseline_f1", None)
def q_baseline_f1(spark, sf_dir):
    """M9: F1 of class 1 on train and test of the baseline, one pass."""
    from .workflow import f1_by_split, fit_baseline
    _, data = _fitting_data(spark, sf_dir)
    return f1_by_split(fit_baseline(data), data)


# Fixed predictions of simple rules, so that F1, run log, filter and top-1 can
# be checked in SQL without a fitted model.
RULES = {
    "damage_rule": "cast(Vehicle_Damage = 'Yes' and Previously_Insured = 0 as int)",
    "claims_rule": "cast(Claims_Amount > 200 as int)",
    "never": "0",
}


def _rule_scores(spark, sf_dir) -> DataFrame:
    """One scan: every row once per rule, with that rule's prediction."""
    rules = F.array(*[F.struct(F.lit(k).alias("algorithm"), F.expr(v).alias("prediction")) for k, v in RULES.items()])
    return (_balanced_split(spark, sf_dir)
            .select("id", "copy", "split", "Response", F.explode(rules).alias("r"))
            .select("id", "copy", "split", "Response", "r.algorithm", "r.prediction"))


@register("rule_f1", O.rule_f1())
def q_rule_f1(spark, sf_dir):
    """M9: F1 of class 1 and (R form) class 0 per rule and split."""
    from ..operators.evaluate import f1
    scored = sampling.materialize(_rule_scores(spark, sf_dir), "rule-scores")
    by = ["algorithm", "split"]
    return (f1(scored, by=by).withColumn("positive", F.lit(1))
            .unionByName(f1(scored, by=by, positive=0).withColumn("positive", F.lit(0))))


def _rule_runs(spark, sf_dir) -> DataFrame:
    """One logged run per rule, named by its rule."""
    from ..operators import runs
    from ..operators.evaluate import f1
    path = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    scored = f1(_rule_scores(spark, sf_dir), by=["algorithm", "split"]).collect()  # 2 rows a rule
    for name in RULES:
        metrics = {f"f1_{r['split']}": r["f1"] for r in scored if r["algorithm"] == name}
        runs.log_run(spark, path, "rules", name, {"rule": name}, metrics, run_id=name)
    return runs.read_runs(spark, path)


def _run_columns(found: DataFrame) -> DataFrame:
    return found.select("run_id", "algorithm", F.col("metrics")["f1_train"].alias("f1_train"),
                        F.col("metrics")["f1_test"].alias("f1_test"))


@register("rule_runs", O.rule_runs())
def q_rule_runs(spark, sf_dir):
    """The logged runs over the acceptance threshold, best first."""
    from ..operators import runs
    return _run_columns(runs.search_runs(_rule_runs(spark, sf_dir), "rules"))


@register("rule_best_run", O.rule_runs() + " limit 1")
def q_rule_best_run(spark, sf_dir):
    """The best accepted run."""
    from ..operators import runs
    return _run_columns(runs.best_run(_rule_runs(spark, sf_dir), "rules"))


def _stage_params(pipe) -> dict:
    """What a pipeline's learner was set to."""
    import dataclasses
    stage = pipe.getStages()[-1]
    if hasattr(stage, "settings"):
        return dataclasses.asdict(stage.settings)
    return {p.name: v for p, v in stage.extractParamMap().items()
            if p.name in ("regParam", "elasticNetParam", "maxIter", "maxDepth", "numTrees")}


def _logged_models(spark, sf_dir, positive=1):
    """The R training path: exact stratified split of the balanced table, factor codes
    and scales fitted on train, three models; every run logs its F1 (of class
    ``positive``) and the path of its saved pipeline."""
    from ..operators import models, runs, score
    from .workflow import f1_by_split, metrics_dict, training_frame
    base = sampling.materialize(prepared(spark, sf_dir), "prepared")
    data = sampling.materialize(
        sampling.stratified_split(sampling.rebalance(base), key=["id", "copy"]), "model-data")
    train = training_frame(data)
    path = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    try:
        for algo, pipe in (("elastic_net", models.elastic_net_pipeline()),
                           ("boosted_trees", models.boosted_pipeline(coding="factor")),
                           ("linear", models.linear_pipeline())):
            model = pipe.fit(train)
            saved = scratch_path(spark, f"model-{algo}-{uuid.uuid4().hex}")
            score.save_model(model, saved)
            runs.log_run(spark, path, "propensity", algo, _stage_params(pipe),
                         metrics_dict(f1_by_split(model, data, positive=positive)), model_path=saved)
    finally:
        train.unpersist()
    return base, data, runs.read_runs(spark, path)


@register("model_runs", None)
def q_model_runs(spark, sf_dir):
    """M5-M7 + M9 + M10: elastic net, boosted trees and the penalised linear
    model, each logged with F1 train/test of class 0 (R form); the runs with
    f1_test > 0.25, best first."""
    from ..operators import runs
    *_, logged = _logged_models(spark, sf_dir, positive=0)
    return runs.search_runs(logged, "propensity").select(
        "algorithm", F.col("metrics")["f1_train"].alias("f1_train"),
        F.col("metrics")["f1_test"].alias("f1_test"))


@register("best_run_scores", None)
def q_best_run_scores(spark, sf_dir):
    """M10-M14 in a chain: models logged with their saved pipelines, the best
    run over the threshold looked up, its pipeline loaded, and the recombined
    balanced table and the whole unbalanced table scored with it."""
    from ..operators import runs, score
    base, data, logged = _logged_models(spark, sf_dir)
    best = runs.best_run(logged, "propensity").first()
    if best is None:
        raise ValueError("no run reached the acceptance threshold")
    model = score.load_model(best["model_path"])
    recombined = sampling.recombine(data.where(F.col("split") == "train"),
                                    data.where(F.col("split") == "test"))
    balanced = score.score(recombined, model).select(
        F.lit("balanced").alias("relation"), "id", "copy", "Response", "prediction")
    whole = score.score(base, model).select(
        F.lit("whole").alias("relation"), "id", F.lit(1).cast("bigint").alias("copy"),
        "Response", "prediction")
    return balanced.unionByName(whole)


@register("scored_table", None)
def q_scored_table(spark, sf_dir):
    """U1 + M13: train/test recombined (inference data), scored by the boosted
    model and saved as a table; the saved table is returned."""
    from ..operators import models
    from ..operators.score import score_to_table
    from .workflow import training_frame
    _, data = _fitting_data(spark, sf_dir)
    train = training_frame(data)
    try:
        model = models.boosted_pipeline().fit(train)
    finally:
        train.unpersist()
    inference = sampling.recombine(data.where(F.col("split") == "train"),
                                   data.where(F.col("split") == "test"))
    name, path = _scratch_table(spark, "scored")
    score_to_table(inference, model, name, path=path)
    return _release(spark, name)


@register("search_runs", None)
def q_search_runs(spark, sf_dir):
    """M8: ten draws of depth and leaf penalties over the whole space, the round count
    tuned on a validation slice of train, every run logged; the runs with
    f1_test > 0.25, best first."""
    from ..operators import runs, search
    _, data = _fitting_data(spark, sf_dir)
    path = scratch_path(spark, f"runs-{uuid.uuid4().hex}")
    for i, run in enumerate(search.search(data.where("split = 'train'"), data.where("split = 'test'"))):
        runs.log_run(spark, path, "search", "boosted_trees", run["params"], run["metrics"], run_id=f"rank-{i:03d}")
    found = runs.search_runs(runs.read_runs(spark, path), "search")
    return found.select("run_id", *[F.col("params")[c].cast(t).alias(c) for c, t in (
        ("max_depth", "int"), ("n_estimators", "int"), ("reg_alpha", "double"), ("reg_lambda", "double"))],
        *[F.col("metrics")[m].alias(m) for m in ("f1_train", "f1_validation", "f1_test")])


# --- the learners' steps and fixed models, oracle-checked --------------------------

@register("boosted_stump", O.boosted_stump(S.BASELINE_FEATURES, O.STUMP_PENALTIES, 32))
def q_boosted_stump(spark, sf_dir):
    """M6: one round of depth 1 under several leaf penalties, as its node table."""
    from ..operators import boosting
    data = sampling.materialize(prepared(spark, sf_dir), "prepared")
    cuts = boosting.cut_points(data, S.BASELINE_FEATURES, 32)
    rows = []
    for alpha, lam in O.STUMP_PENALTIES:
        trees, _ = boosting.fit_trees(data, S.BASELINE_FEATURES, S.LABEL, boosting.Settings(
            n_estimators=1, max_depth=1, learning_rate=0.1, reg_alpha=alpha, reg_lambda=lam, bins=32), cuts)
        root, *leaves = boosting.node_rows(trees, cuts)
        if leaves:                                      # the penalties may allow no split
            rows.append((alpha, lam, S.BASELINE_FEATURES[root[2]], root[3], round(root[7], 6),
                         *[round(leaf[6], 9) for leaf in leaves]))
    return spark.createDataFrame(rows, "reg_alpha double, reg_lambda double, feature string, threshold double, "
                                       "gain double, left_value double, right_value double")


@register("linear_booster_round", O.linear_booster_round(S.BASELINE_FEATURES, 0.1, 0.1, 0.1))
def q_linear_booster_round(spark, sf_dir):
    """M7: one round of the linear booster on sd-scaled features, as its coefficient table."""
    from ..operators import boosting
    from ..operators.models import sd_scale_sql
    data = prepared(spark, sf_dir)
    data = sampling.materialize(data, "prepared")
    scaled = sd_scale_sql(data, data, S.BASELINE_FEATURES)
    intercept, weights = boosting.fit_linear(scaled, S.BASELINE_FEATURES, S.LABEL,
                                             boosting.LinearSettings(1, 0.1, 0.1, 0.1))
    rows = list(zip(["intercept", *S.BASELINE_FEATURES], [round(float(w), 9) for w in (intercept, *weights)]))
    return spark.createDataFrame(rows, "term string, weight double")


@register("factor_stage_codes", O.with_prepared(O.factor_stage(list(S.ENCODERS))))
def q_factor_stage_codes(spark, sf_dir):
    """X13 as a fitted stage: levels learned on the train split, saved, loaded, and
    applied to the whole table."""
    from pyspark.ml import Pipeline
    from ..operators import models, score
    data = sampling.materialize(sampling.split(prepared(spark, sf_dir)), "factor-data")
    saved = scratch_path(spark, f"factors-{uuid.uuid4().hex}")
    score.save_model(Pipeline(stages=models.factor_stages()).fit(data.where("split = 'train'")), saved)
    return score.load_model(saved).transform(data).select("id", *[f"x_{c}" for c in S.ENCODERS])


def _reloaded(spark, *stages):
    """A fixed model as a pipeline that was saved and loaded."""
    from pyspark.ml import PipelineModel
    from ..operators import score
    saved = scratch_path(spark, f"fixed-{uuid.uuid4().hex}")
    score.save_model(PipelineModel(stages=list(stages)), saved)
    return score.load_model(saved)


@register("ensemble_scores", O.with_prepared(O.ENSEMBLE_SCORES))
def q_ensemble_scores(spark, sf_dir):
    """A fixed tree ensemble scores every row of the whole table."""
    from ..operators import boosting, models, score
    model = _reloaded(spark, models.assemble(O.FIXED_FEATURES), boosting.tree_model(
        spark, O.FIXED_NODES, len(O.FIXED_FEATURES)))
    scored = score.score(prepared(spark, sf_dir), model, probability="probability")
    return rounded(scored.select("id", "prediction", "probability"), 9, "probability")


@register("linear_scores", O.with_prepared(O.LINEAR_SCORES))
def q_linear_scores(spark, sf_dir):
    """A fixed linear model scores the whole table into a saved table."""
    from ..operators import boosting, models, score
    model = _reloaded(spark, models.assemble(O.FIXED_FEATURES), boosting.linear_model(
        spark, O.FIXED_INTERCEPT, O.FIXED_WEIGHTS))
    name, path = _scratch_table(spark, "linear_scored")
    score.score_to_table(prepared(spark, sf_dir), model, name, path=path)
    return _release(spark, name).select("id", "Response", "prediction")


@register("ensemble_nodes", O.ENSEMBLE_NODES)
def q_ensemble_nodes(spark, sf_dir):
    """A saved ensemble read back as its node table, with how many rows of the
    whole table reach each leaf (the trees walked relationally, level by level)."""
    from ..operators import boosting, score
    saved = scratch_path(spark, f"nodes-{uuid.uuid4().hex}")
    score.save_model(boosting.tree_model(spark, O.FIXED_NODES, len(O.FIXED_FEATURES)), saved)
    nodes = boosting.nodes_of(spark, saved)
    leaves = boosting.leaf_of(prepared(spark, sf_dir), nodes, O.FIXED_FEATURES)
    reached = leaves.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"))
    return (nodes.drop("gain").join(reached, ["tree", "node"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0))).drop("left", "right"))


@register("split_first", O.split_first())
def q_split_first(spark, sf_dir):
    """The leak-free order: customers split first, only train bootstrapped."""
    from .workflow import balanced_split
    return balanced_split(prepared(spark, sf_dir, columns=[]), order="split_first").select(
        "id", "copy", "split", "Response")


@register("describe_all", O.with_prepared(O.describe_all(S.BASE_COLUMNS, NUMERIC_COLS)))
def q_describe_all(spark, sf_dir):
    """A3, R form: count, mean, stddev, min, max of every column, text included."""
    wide = profile.describe_all(prepared(spark, sf_dir))
    long = wide.unpivot(["summary"], list(S.BASE_COLUMNS), "column", "value")
    number = F.col("column").isin(NUMERIC_COLS) | F.col("summary").isin("count", "mean", "stddev")
    return long.select("summary", "column",
                       F.when(number, F.round(F.col("value").try_cast("double"), 6)).alias("number"),
                       F.when(~number, F.col("value")).alias("text"))


@register("saved_view", O.with_prepared(O.SAVED_VIEW))
def q_saved_view(spark, sf_dir):
    """A database made, a table saved in it, a view over it published, and the
    view read from a second session of the same catalog."""
    db = f"propensity_{uuid.uuid4().hex[:12]}"
    tables.reset_database(spark, db)
    try:
        path = scratch_path(spark, f"table-{db}")
        tables.save_table(prepared(spark, sf_dir, columns=["Region_Code"]), f"{db}.prospects", path=path)
        tables.create_saved_view(spark, f"{db}.active_regions",
                                 "SELECT Region_Code AS region_code, count(*) AS claimants, max(Claims_Amount) AS "
                                 f"largest FROM {db}.prospects WHERE Claims_Num > 0 GROUP BY Region_Code")
        seen = tables.read_table(spark.newSession(), f"{db}.active_regions")
        return sampling.materialize(seen, "view-rows")
    finally:
        tables.drop_database(spark, db)


@register("catalog_listing", None)
def q_catalog_listing(spark, sf_dir):
    """Databases and tables before and after a reset, as listed."""
    db = f"propensity_{uuid.uuid4().hex[:12]}"
    rows = []

    def listed(step):
        there = [r[0] for r in tables.list_databases(spark).collect()]
        names = sorted(r["tableName"] for r in tables.list_tables(spark, db).collect()) if db in there else []
        rows.append((step, db in there, ",".join(names)))

    listed("before")
    tables.reset_database(spark, db)
    tables.save_table(prospects(spark, sf_dir), f"{db}.prospects", path=scratch_path(spark, f"table-{db}"))
    tables.create_saved_view(spark, f"{db}.insured", f"SELECT id FROM {db}.prospects WHERE Previously_Insured = 1")
    listed("saved")
    tables.reset_database(spark, db)
    listed("reset")
    tables.drop_database(spark, db)
    listed("dropped")
    return spark.createDataFrame(rows, "step string, database_there boolean, tables string")


# --- chart frames of the balanced sample ---------------------------------------

@register("sample_histograms", O.sample_charts(S.BASELINE_FEATURES, "histogram"))
def q_sample_histograms(spark, sf_dir):
    """R1 -> R3 -> A10 for each of the five chosen features."""
    return _charts(spark, sf_dir, lambda df, c: profile.histogram_by(df, c))


@register("sample_boxes", O.sample_charts(S.BASELINE_FEATURES, "box"))
def q_sample_boxes(spark, sf_dir):
    """R1 -> R3 -> A11 for each of the five chosen features."""
    return _charts(spark, sf_dir, lambda df, c: profile.box_by(df, c))


def _charts(spark, sf_dir, chart):
    sample = sampling.materialize(
        sampling.sample_n(rebalanced(spark, sf_dir), S.SAMPLE_ROWS, key=["id", "copy"]), "chart-sample")
    frames = [chart(sample, c).withColumn("feature", F.lit(c)) for c in S.BASELINE_FEATURES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# --- remaining forms ----------------------------------------------------------------

@register("encoded_in_place", O.with_prepared(O.ENCODED_IN_PLACE))
def q_encoded_in_place(spark, sf_dir):
    """X12 overwriting the text columns."""
    return encode(prepared(spark, sf_dir), prefix="")


@register("packed", O.with_prepared(O.PACKED))
def q_packed(spark, sf_dir):
    """P4 + P7: the first column dropped by position, features packed into a struct."""
    df = pack(prepared(spark, sf_dir), S.BASELINE_FEATURES)
    return profile.drop_first(df).select("Response", *[
        F.col(f"features.{c}").alias(f"f_{c}") for c in S.BASELINE_FEATURES])


@register("rebalance_keep_majority", O.REBALANCED_MINORITY)
def q_rebalance_keep_majority(spark, sf_dir):
    """R1 with the majority class left as it is."""
    return sampling.rebalance(prepared(spark, sf_dir), resample_majority=False)


@register("table_partitions", O.PREPARED)
def q_table_partitions(spark, sf_dir):
    """Saved as a managed table with a given number of partitions."""
    name = f"prepared_{uuid.uuid4().hex[:12]}"
    tables.save_table(prepared(spark, sf_dir), name, partitions=4)
    saved = sampling.materialize(tables.read_table(spark, name), "managed-copy")
    tables.drop_table(spark, name)
    return saved
