"""Exploration operators: filters, region roll-ups, summaries, shares,
correlations, histograms and box summaries.

All of them are Spark aggregations over the whole table.  Results are
aggregated (bounded by the number of columns, categories, bins or regions);
nothing row-level goes to the driver.  Scalars a row needs (min, max, group
sizes) arrive as scalar subqueries, never through an unpartitioned window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def premium_by_age(df: DataFrame, min_premium: float = 500) -> DataFrame:
    """(annual_premium, age) where annual_premium > min_premium."""
    return (df.where(F.col("Annual_Premium") > F.lit(min_premium))
            .select(F.col("Annual_Premium").alias("annual_premium"), F.col("Age").alias("age")))


def numeric_columns(df: DataFrame, exclude=S.DESCRIBE_EXCLUDE) -> list[str]:
    """Numeric columns not in ``exclude`` (schema only; no data touched)."""
    return [f.name for f in df.schema.fields
            if f.name not in exclude and isinstance(f.dataType, NUMERIC_TYPES)]


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3: count, mean, sample stddev, min, max per column, one pass, long form
    (feature, count, mean, stddev, min, max) with typed doubles.  NULL and NaN
    are missing values: in none of the five."""
    cols = cols if cols is not None else numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__sd"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__n").alias("count"),
                              F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__sd").alias("stddev"),
                              F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
                     for c in cols])
    return wide.select(F.inline(rows))


def describe_all(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A3, R form: count, mean, stddev, min, max of every column (strings
    included: mean/stddev NULL, min/max by text order), one pass; Spark's own
    summary table, string-typed like the source it mirrors."""
    return df.describe(*(cols or df.columns))


def class_balance(df: DataFrame, label: str = S.LABEL, key: str | None = S.KEY) -> DataFrame:
    """A2: rows per label value; counts non-null ``key`` (Python form) or all
    rows when ``key`` is None (R form)."""
    n = F.count(F.col(key)) if key else F.count(F.lit(1))
    return df.groupBy(label).agg(n.alias("n"))


def count_where(df: DataFrame, cond, name: str = "n") -> DataFrame:
    """One-row filtered count (``count_if``)."""
    return df.agg(F.count_if(cond).alias(name))


def to_long(df: DataFrame, cols: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """Wide -> long, every value cast to string first."""
    return (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], cols, name, value))


def category_share(df: DataFrame, cols: list[str] = S.SHARE_COLUMNS,
                   mode: str = "percent1") -> DataFrame:
    """A4 (+W1, X8): frequency and share of each value of each column, all
    columns in one aggregation.

    ``percent1``: NULLs dropped, share in percent rounded to 1 decimal, label
    text like ``'12.3%'``.  ``fraction2``: NULLs kept as a group, fraction
    rounded to 2 decimals, label like ``'0.12'``.

    W1 (share within the column): the per-column totals are summed from
    the aggregated counts (the counts' shuffle is reused, no second scan)
    and joined back by broadcast -- that table has exactly one row per
    profiled column, so no window partition ever holds all values of a
    high-cardinality column."""
    if mode not in ("percent1", "fraction2"):
        raise ValueError("mode must be 'percent1' or 'fraction2'")
    long = to_long(df, cols)
    if mode == "percent1":
        long = long.where(F.col("value").isNotNull())
    counts = long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("name").agg(F.sum("n").alias("_total"))   # len(cols) rows
    counts = counts.join(F.broadcast(totals), "name")
    total = F.col("_total")
    if mode == "percent1":
        prc = F.round(F.lit(100.0) * F.col("n").cast("double") / total.cast("double"), 1)
        label = F.format_string("%.1f%%", F.col("prc"))
    else:
        prc = F.round(F.col("n").cast("double") / total.cast("double"), 2)
        label = F.format_string("%.2f", F.col("prc"))
    out = counts.withColumn("prc", prc).withColumn("label", label).drop("_total")
    # O3: per column, largest share first (percent1) or by (name, prc) (fraction2).
    if mode == "percent1":
        return out.orderBy("name", F.col("n").desc(), "value")
    return out.orderBy("name", "prc", "value")


def _pair_moments(cols: list[str]):
    """Per task: for every column pair (i <= j) the count, means and central
    moments over rows where both are present, from matrix products per batch."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        k = len(cols)
        shift, n, sx, sxx, sxy = None, *(np.zeros((k, k)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            if not len(x):
                continue
            m = ~np.isnan(x)
            if shift is None:   # near the data: keeps the sums of squares well conditioned
                shift = np.array([x[m[:, i], i][0] if m[:, i].any() else 0.0 for i in range(k)])
            x = np.where(m, x - shift, 0.0)
            m = m.astype(float)
            n += m.T @ m
            sx += x.T @ m
            sxx += (x * x).T @ m
            sxy += x.T @ x
        if shift is None:
            return
        i, j = np.triu_indices(k)
        c = np.maximum(n[i, j], 1)
        out = [i, j, n[i, j], sx[i, j] / c + shift[i], sx[j, i] / c + shift[j],
               sxx[i, j] - sx[i, j] ** 2 / c, sxx[j, i] - sx[j, i] ** 2 / c,
               sxy[i, j] - sx[i, j] * sx[j, i] / c]
        yield pa.RecordBatch.from_arrays(
            [pa.array(v.astype(np.int32 if at < 2 else float)) for at, v in enumerate(out)],
            names=["i", "j", "n", "mx", "my", "xx", "yy", "xy"])
    return run


def correlation_long(df: DataFrame, cols: list[str] | None = None,
                     factors: bool = False) -> DataFrame:
    """Pearson correlation of every column pair, long form
    (col1, col2, value), pairwise-complete like pandas / SQL corr().

    One pass over the table whatever the number of columns: every task
    reduces its rows to one row of moments per pair, and these are merged by
    the parallel-variance formula.  NULL and NaN are missing; a pair in which
    a column does not vary gives NULL.

    ``factors=True`` (R form) first replaces string columns by their 1-based
    alphabetical codes and includes them."""
    if factors:
        from ..functions.encode import factor_codes
        strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
                   and (cols is None or f.name in cols)]
        df = factor_codes(df, strings)
        if cols is None:
            cols = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)]
    cols = cols if cols is not None else numeric_columns(df, exclude=[])
    parts = (df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
             .mapInArrow(_pair_moments(cols), "i int, j int, n double, mx double, my double, "
                                              "xx double, yy double, xy double")
             .where("n > 0"))
    pair = Window.partitionBy("i", "j")      # one row per task and pair
    centred = parts.select(
        "*", (F.sum(F.col("n") * F.col("mx")).over(pair) / F.sum("n").over(pair)).alias("gx"),
        (F.sum(F.col("n") * F.col("my")).over(pair) / F.sum("n").over(pair)).alias("gy"))
    dx, dy = F.col("mx") - F.col("gx"), F.col("my") - F.col("gy")
    merged = centred.groupBy("i", "j").agg(
        F.sum(F.col("xx") + F.col("n") * dx * dx).alias("xx"),
        F.sum(F.col("yy") + F.col("n") * dy * dy).alias("yy"),
        F.sum(F.col("xy") + F.col("n") * dx * dy).alias("xy"),
        ((F.max("xx") > 0) | (F.min("mx") < F.max("mx"))).alias("vx"),
        ((F.max("yy") > 0) | (F.min("my") < F.max("my"))).alias("vy"))
    value = F.when(F.col("vx") & F.col("vy"),
                   F.when(F.col("i") == F.col("j"), F.lit(1.0))
                   .otherwise(F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))))
    names = F.array(*[F.lit(c) for c in cols])
    a, b = F.element_at(names, F.col("i") + 1), F.element_at(names, F.col("j") + 1)
    both = F.struct(a.alias("col1"), b.alias("col2"), value.alias("value"))
    turned = F.struct(b.alias("col1"), a.alias("col2"), value.alias("value"))
    rows = F.when(F.col("i") == F.col("j"), F.array(both)).otherwise(F.array(both, turned))
    return merged.select(F.inline(rows))


def histogram_by(df: DataFrame, col: str, label: str = S.LABEL, bins: int = 30) -> DataFrame:
    """A10: equal-width histogram of ``col`` per label over the global range.
    bin = least(floor((x - lo) * bins / (hi - lo)), bins - 1); all values fall
    in bin 0 when hi = lo.  NULL values are skipped."""
    x = F.col(col).cast("double")
    rng = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = rng.select("lo").scalar(), rng.select("hi").scalar()
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) * F.lit(float(bins)) / (hi - lo)), F.lit(bins - 1)))
    counts = (df.where(x.isNotNull()).groupBy(F.col(label), b.cast("int").alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    width = (hi - lo) / F.lit(float(bins))
    return counts.select(label, "bin", (lo + F.col("bin") * width).alias("bin_lo"),
                         (lo + (F.col("bin") + 1) * width).alias("bin_hi"), "n")


def region_opportunity(df: DataFrame) -> DataFrame:
    """A1 (flagship): prospects, premium, claims amount and count per region.

    Partial aggregation runs map-side, so the shuffle carries at most one row
    per (task, region); a region holding a third of all rows costs nothing
    extra."""
    return df.groupBy(F.col("Region_Code").alias("region_code")).agg(
        F.count(F.lit(1)).alias("region_prospects"),
        F.sum("Annual_Premium").alias("total_annual_premium"),
        F.sum("Claims_Amount").cast("bigint").alias("total_claims_amount"),
        F.sum("Claims_Num").cast("bigint").alias("total_claims_count"),
    )


def regions_ranked(regions: DataFrame) -> DataFrame:
    """O2: regions by prospect count (region code breaks ties)."""
    return regions.select("region_code", "region_prospects").orderBy("region_prospects", "region_code")


def region_bubble(regions: DataFrame) -> DataFrame:
    """Chart frame for the region bubble plot: log10 of the claims count
    (NULL when the count is 0), premium and prospects."""
    cnt = F.col("total_claims_count")
    return regions.select(
        "region_code", "region_prospects", "total_annual_premium", "total_claims_count",
        F.when(cnt > 0, F.log10(cnt.cast("double"))).alias("log10_claims_count"))


def feature_by_label(df: DataFrame, feature: str, label: str = S.LABEL) -> DataFrame:
    """P5: the chosen feature renamed to ``x`` and the label as text."""
    return df.select(F.col(feature).alias("x"), F.col(label).cast("string").alias(label))


def drop_first(df: DataFrame) -> DataFrame:
    """Drop the first column by position (P3 is plain ``drop``/``select``)."""
    return df.drop(df.columns[0])


def preview(df: DataFrame, n: int = 100, order: list[str] | None = None) -> DataFrame:
    """Bounded preview; with ``order`` the rows are a total-order top-n."""
    return (df.orderBy(*order) if order else df).limit(n)


def box_by(df: DataFrame, col: str, label: str = S.LABEL) -> DataFrame:
    """Box-plot summary per label: exact quartiles (linear interpolation
    between order statistics, like ``quantile_cont``), 1.5 IQR whiskers and
    the outlier count.  NULL values are skipped, NaN counts as the largest.

    The order statistics come from counts of leading bits (see ``quantiles``): no
    sort, nothing row-level written; a last aggregate finds whiskers and outliers."""
    from .quantiles import order_values
    from .sampling import group_key, materialize

    base = (df.select(F.col(label), F.col(col).cast("double").alias("_x"), group_key([label]).alias("_g"))
            .where(F.col("_x").isNotNull()))
    x, m = F.col("_x"), (F.col("_m") - F.lit(1)).cast("double")
    places = {name: F.lit(p) * m for name, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))}
    wanted = lambda totals: totals.select("_g", F.explode(F.array(*[
        F.struct(F.lit(name).alias("_q"), h.alias("_h"), F.floor(h).alias("_lo"), F.ceil(h).alias("_hi"))
        for name, h in places.items()])).alias("p")).select("_g", "p.*")
    asked = []

    def ranks(totals):
        asked.append(wanted(totals))
        return asked[0].select("_g", F.explode(F.array("_lo", "_hi")).alias("_rank"))

    values = order_values(base.select("_g", "_x"), ranks)
    at = lambda end: values.select("_g", F.col("_rank").alias(end), F.col("_x").alias(f"_v{end}"))
    quart = materialize(
        asked[0].join(at("_lo"), ["_g", "_lo"]).join(at("_hi"), ["_g", "_hi"])
        .select("_g", "_q", (F.col("_v_lo") + (F.col("_h") - F.col("_lo")) * (F.col("_v_hi") - F.col("_v_lo")))
                .alias("_x")).groupBy("_g").pivot("_q", list(places)).agg(F.first("_x")), "quartiles")
    iqr = F.col("q3") - F.col("q1")
    lf, uf = F.col("q1") - F.lit(1.5) * iqr, F.col("q3") + F.lit(1.5) * iqr
    return (base.join(quart, "_g").withColumns({"_lf": lf, "_uf": uf}).groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.min(x).alias("min"),
        F.first("q1").alias("q1"), F.first("median").alias("median"),
        F.first("q3").alias("q3"), F.max(x).alias("max"),
        F.min(F.when(x >= F.col("_lf"), x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("_uf"), x)).alias("whisker_high"),
        F.count_if((x < F.col("_lf")) | (x > F.col("_uf"))).alias("outliers")))
