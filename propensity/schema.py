"""Table schema, feature lists, encoder maps and the workflow's fixed constants."""

from __future__ import annotations

from pyspark.sql import types as T

# Base customer table: the raw CSV columns (first 12) plus the two synthesised
# claims columns.
RAW_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Driving_License", T.IntegerType()),
    T.StructField("Region_Code", T.DoubleType()),
    T.StructField("Previously_Insured", T.IntegerType()),
    T.StructField("Vehicle_Age", T.StringType()),
    T.StructField("Vehicle_Damage", T.StringType()),
    T.StructField("Annual_Premium", T.DoubleType()),
    T.StructField("Policy_Sales_Channel", T.DoubleType()),
    T.StructField("Vintage", T.IntegerType()),
    T.StructField("Response", T.IntegerType()),
])
BASE_SCHEMA = T.StructType(RAW_SCHEMA.fields + [
    T.StructField("Claims_Amount", T.IntegerType()),
    T.StructField("Claims_Num", T.IntegerType()),
])
BASE_COLUMNS = [f.name for f in BASE_SCHEMA.fields]

LABEL = "Response"
KEY = "id"

# ---------------------------------------------------------------------------
# These must equal the workflow being rebuilt.
# ---------------------------------------------------------------------------
# Claims synthesis (lognormal amount, count derived from amount, premium rescale).
CLAIMS_MAX_AMOUNT = 120000
CLAIMS_SIGMA = 1.75
CLAIMS_LOW_CUTOFF = 10            # amounts below this become 0
CLAIMS_JITTER = 0.2               # amount * (1 + U(-0.2, 0.2))
CLAIMS_POSITIVE_LOW = 1.8         # Response = 1 rows: amount * U(1.8, 3.0)
CLAIMS_POSITIVE_HIGH = 3.0
CLAIMS_AVG_CLAIM = 40
CLAIMS_NUM_LOW = 1.0 / 3          # count factor U(1/3, 3)
CLAIMS_NUM_HIGH = 3.0
PREMIUM_TARGET_MEAN = 40 * 52     # 2080

# Columns left out of the numeric summary.
DESCRIBE_EXCLUDE = ["id", "Gender", "Vehicle_Age", "Vehicle_Damage", "Region_Code",
                    "Driving_License", "Previously_Insured", "Policy_Sales_Channel",
                    "Response"]
# Categorical columns whose value shares are profiled.
SHARE_COLUMNS = ["Vehicle_Age", "Gender", "Vehicle_Damage", "Driving_License",
                 "Previously_Insured"]
# Feature lists (the baseline's are also those charted by label).
BASELINE_FEATURES = ["Age", "Previously_Insured", "Policy_Sales_Channel",
                     "Claims_Amount", "Claims_Num"]
EXTENDED_FEATURES = BASELINE_FEATURES + ["Driving_License", "Region_Code",
                                         "Annual_Premium", "Vintage", "x_Gender",
                                         "x_Vehicle_Age", "x_Vehicle_Damage"]

# Ordinal encoders.
ENCODERS = {
    "Gender": {"Male": 0, "Female": 1},
    "Vehicle_Age": {"< 1 Year": 0, "1-2 Year": 1, "> 2 Years": 2},
    "Vehicle_Damage": {"No": 0, "Yes": 1},
}

# Baseline random forest and the boosted / linear model settings.
BASELINE_RF = {"n_estimators": 200, "max_depth": 7}
BOOSTED_R = {"nrounds": 25, "max_depth": 2, "eta": 0.1, "gamma": 0.01,
             "colsample_bytree": 1, "min_child_weight": 1, "subsample": 1}
LINEAR_R = {"nrounds": 100, "eta": 0.1, "lambda": 0.1, "alpha": 0.1}
ELASTIC_NET_R = {"alpha": 0.5, "lambda": 0.5}
# Hyper-parameter search space and budget.
SEARCH_SPACE = {"max_depth": (2, 11), "n_estimators": (50, 250),
                "reg_alpha": (0.001, 0.1), "reg_lambda": (0.001, 0.1)}
SEARCH_EVALS = 10
SPLIT_SEED = 6789
TEST_FRACTION = 0.2
MIN_F1_TEST = 0.25
SAMPLE_ROWS = 10000
