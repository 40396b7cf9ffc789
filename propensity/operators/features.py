"""Feature synthesis: claims amount (G1), claims count (G2), premium rescale.

Global scalars (max, min, mean) are scalar subqueries on the same frame
(``DataFrame.scalar()``): Spark computes each one-row aggregate once with a
partial/final aggregation and substitutes the value; no window over the whole
table, no join and nothing collected by our code.  Subqueries over the same
input are merged by the optimizer into one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.exact import exact_mean
from ..functions.keyed import lognormal, normal, u


def with_global(df: DataFrame, **aggs: Column) -> DataFrame:
    """Attach one-row aggregates of ``df`` to every row."""
    scalars = df.agg(*[e.alias(n) for n, e in aggs.items()])
    return df.withColumns({n: scalars.select(n).scalar() for n in aggs})


def add_claims_amount(df: DataFrame, key: str = S.KEY, label: str = S.LABEL,
                      max_amount: float = S.CLAIMS_MAX_AMOUNT, sigma: float = S.CLAIMS_SIGMA,
                      dist: str = "lognormal", low: str = "zero",
                      out: str = "Claims_Amount", salt: str = "c") -> DataFrame:
    """G1.  draw -> scale so the max is ``max_amount`` -> low amounts to 0
    (``low='zero'``) or floored at the cutoff (``low='floor'``) -> jitter
    x U(0.8, 1.2) -> positives x U(1.8, 3.0) -> int.  The cutoff precedes the
    jitter, so the smallest non-zero amount can be below it."""
    if dist == "lognormal":
        draw = lognormal(key, f"{salt}1", f"{salt}2", sigma)
    elif dist == "normal":
        draw = normal(key, f"{salt}1", f"{salt}2", sigma)
    else:
        raise ValueError(f"dist must be 'lognormal' or 'normal', not {dist!r}")
    d = df.withColumn("_draw", draw)
    mx = d.agg(F.max("_draw")).scalar()
    scaled = F.col("_draw") * (F.lit(float(max_amount)) / mx)
    cut = float(S.CLAIMS_LOW_CUTOFF)
    if low == "zero":
        kept = F.when(scaled < cut, F.lit(0.0)).otherwise(scaled)
    elif low == "floor":
        kept = F.greatest(scaled, F.lit(cut))
    else:
        raise ValueError(f"low must be 'zero' or 'floor', not {low!r}")
    jitter = F.lit(1.0 - S.CLAIMS_JITTER) + F.lit(2 * S.CLAIMS_JITTER) * u(key, f"{salt}3")
    boost = F.when(F.col(label) == 1,
                   F.lit(S.CLAIMS_POSITIVE_LOW)
                   + F.lit(S.CLAIMS_POSITIVE_HIGH - S.CLAIMS_POSITIVE_LOW) * u(key, f"{salt}4")
                   ).otherwise(F.lit(1.0))
    amount = kept * jitter * boost
    # round(.., 6) before truncation: generated doubles may differ in the last
    # bit between engines; six decimals make the integer part stable.
    return d.withColumn(out, F.floor(F.round(amount, 6)).cast("int")).drop("_draw")


def add_claims_num(df: DataFrame, key: str = S.KEY, amount: str = "Claims_Amount",
                   avg_claim: float = S.CLAIMS_AVG_CLAIM, out: str = "Claims_Num",
                   salt: str = "c") -> DataFrame:
    """G2.  Rows with a positive amount: (amount/avg)*U(1/3, 3) minus the
    minimum of that over those rows, floored at 1, as int.  Other rows: 0."""
    pos = F.col(amount) > 0
    factor = F.lit(S.CLAIMS_NUM_LOW) + F.lit(S.CLAIMS_NUM_HIGH - S.CLAIMS_NUM_LOW) * u(key, f"{salt}5")
    d = df.withColumn("_r", F.when(pos, (F.col(amount) / F.lit(float(avg_claim))) * factor))
    mn = d.agg(F.min("_r")).scalar()
    num = F.floor(F.round(F.greatest(F.col("_r") - mn, F.lit(1.0)), 6)).cast("int")
    return d.withColumn(out, F.when(pos, num).otherwise(F.lit(0))).drop("_r")


def normalise_mean(df: DataFrame, col: str = "Annual_Premium",
                   target: float = S.PREMIUM_TARGET_MEAN, to_int: bool = False) -> DataFrame:
    """G3.  Divide by mean/target so the column's mean becomes ``target``."""
    mp = df.agg(exact_mean(col)).scalar()
    v = F.col(col) / (mp / F.lit(float(target)))
    return df.withColumn(col, v.cast("int") if to_int else v)


def prepare(df: DataFrame, key: str = S.KEY, variant: str = "python") -> DataFrame:
    """The chained preparation.  ``variant='r'`` uses the normal draw, the
    floor at the cutoff and an integer premium."""
    if variant == "python":
        out = (df.transform(add_claims_amount, key=key)
               .transform(add_claims_num, key=key)
               .transform(normalise_mean))
    elif variant == "r":
        out = (df.transform(add_claims_amount, key=key, dist="normal", low="floor")
               .transform(add_claims_num, key=key)
               .transform(normalise_mean, to_int=True))
    else:
        raise ValueError("variant must be 'python' or 'r'")
    return out.select(*[c for c in S.BASE_COLUMNS if c in out.columns],
                      *[c for c in out.columns if c not in S.BASE_COLUMNS])
