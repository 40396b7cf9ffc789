"""Resampling and splitting with keyed randomness.

Per-class statistics (sizes, index offsets, cuts, Poisson tables) stay
DataFrames and reach the rows by unhinted joins on the class, so their number
is not limited and Spark sizes each join.  No window spans a whole class and
no row data is collected.  Every draw is a function of (key, salt), so results
do not depend on partitioning, retries or lost executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.keyed import hash_order, u
from ..session import scratch_path

# Draws generated per task chunk, and copies of one row expanded per task.
DRAW_CHUNK = 1 << 20
COPY_CHUNK = 1 << 12
# Hex digits of the hash by which rows are counted to find a cut: 16^5 buckets
# a class, so the bucket that holds the cut has about a millionth of its rows.
CUT_DIGITS = 5
# Draws use 52 bits: every index of a class has the same probability up to 2^-52.
DRAW_DIGITS = 13


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def group_key(by: list[str]) -> Column:
    """Text key of a group; NULL fields get a marker so they form a group too."""
    return F.concat_ws("\u0001", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in by])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts lineage (a lost executor re-reads files instead of recomputing
    non-deterministic steps) and gives column-pruned scans afterwards."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark, files: list[str]) -> None:
    """Delete the folder of a written table that nothing reads any more, given its ``inputFiles``."""
    for folder in {f.rsplit("/", 1)[0] for f in files}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def dense_index(df: DataFrame, by: list[str], order: list, name: str = "idx",
                partitions: int | None = None, repeats: str | None = None) -> DataFrame:
    """Contiguous 0-based index of each row within its ``by`` group in
    ``order`` (like row_number() - 1, without one task per group).

    Range-partition on (by, order) so a large group spreads over many tasks,
    sort within partitions, tag rows with (partition id, position), write the
    result once (range boundaries come from sampling and must not be
    recomputed), then join the per-(group, partition) offsets, a prefix sum
    over the count table with one row per pair.  ``repeats`` names a boolean column
    for rows whose (by, order) values an earlier row has: equal values lie in one
    range partition, so it costs no shuffle or sort."""
    ocols = {f"_o{i}": (F.col(c) if isinstance(c, str) else c) for i, c in enumerate(order)}
    okeys = list(ocols)
    tagged = (df.withColumns(ocols)
              .repartitionByRange(partitions or _partitions(df), *by, *okeys)
              .sortWithinPartitions(*by, *okeys))
    if repeats:
        same = Window.partitionBy(*by, *okeys).orderBy(*okeys)
        tagged = tagged.withColumn(repeats, F.row_number().over(same) > 1)
    tagged = (tagged.withColumn("_g", group_key(by))
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())
              .drop(*okeys))
    t = materialize(tagged, "dense-index")
    stats = t.groupBy("_g", "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy("_g").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select("_g", "_pid", (F.coalesce(F.sum("_n").over(before), F.lit(0))
                                          - F.col("_first")).alias("_off"))
    return (t.join(offsets, ["_g", "_pid"])
            .select(*df.columns, *([repeats] if repeats else []), (F.col("_mid") + F.col("_off")).alias(name)))


def smallest_by_hash(df: DataFrame, by: list[str], key: list[str], salt: str, want) -> DataFrame:
    """``df`` plus a boolean ``_in``: whether a row is among the first
    ``want(group size)`` rows of its ``by`` group in order of md5(key:salt), key.

    Rows are neither sorted nor moved: count by hash prefix, take the bucket
    in which the cut falls, rank only that bucket's (hash, key) pairs, and
    compare every row with its group's cut."""
    order = hash_order(row_key(key), salt)
    narrow = df.select(group_key(by).alias("_g"), order.alias("_h"), *key)
    counts = materialize(narrow.groupBy("_g", F.substring("_h", 1, CUT_DIGITS).alias("_b"))
                         .agg(F.count(F.lit(1)).alias("_n")), "hash-counts")
    wanted = (counts.groupBy("_g").agg(F.sum("_n").alias("_m"))
              .select("_g", "_m", want(F.col("_m")).cast("bigint").alias("_want")))
    upto = F.sum("_n").over(Window.partitionBy("_g").orderBy("_b"))
    bucket = (counts.withColumn("_cum", upto).join(wanted, "_g")
              .where((F.col("_cum") >= F.col("_want")) & (F.col("_cum") - F.col("_n") < F.col("_want")))
              .select("_g", "_b", (F.col("_want") - F.col("_cum") + F.col("_n")).alias("_rank")))
    bucket = materialize(bucket, "hash-bucket")
    ranked = F.row_number().over(Window.partitionBy("_g").orderBy("_h", *key))
    cut = (narrow.withColumn("_b", F.substring("_h", 1, CUT_DIGITS)).join(bucket, ["_g", "_b"])
           .withColumn("_r", ranked).where(F.col("_r") == F.col("_rank"))
           .select("_g", F.struct("_h", *key).alias("_cut")))
    ends = materialize(wanted.join(cut, "_g", "left").select(
        "_g", (F.col("_want") >= F.col("_m")).alias("_all"), "_cut"), "hash-cuts")
    here = F.struct(order.alias("_h"), *key)
    if not by:                       # one group: its cut is one row
        end = ends.first()
        if end is None or end["_all"] or end["_cut"] is None:
            return df.withColumn("_in", F.lit(end is not None and bool(end["_all"])))
        cut = F.struct(*[F.lit(v).cast(t.dataType).alias(t.name) for v, t in
                         zip(end["_cut"], ends.schema["_cut"].dataType.fields)])
        return df.withColumn("_in", F.coalesce(here <= cut, F.lit(False)))
    return (df.withColumn("_g", group_key(by)).join(ends, "_g")
            .withColumn("_in", F.col("_all") | F.coalesce(here <= F.col("_cut"), F.lit(False)))
            .drop("_g", "_all", "_cut"))


def expand_copies(rows: DataFrame, count: str, out: str = "copy", keys: list[str] | None = None,
                  chunk: int = COPY_CHUNK, heavy: bool = True) -> DataFrame:
    """Each row as ``count`` copies numbered 1..count.  With ``heavy``, rows of more than
    ``chunk`` copies are cut into chunks that are hash-spread over tasks first, so
    one heavily drawn row never expands inside a single task; a caller that knows
    that there are none leaves that second reading of the input out."""
    # Rows are selected through the generator (an empty array drops a row),
    # not by a Filter: a filter on ``count`` would be pushed below the
    # projection that computes it and re-evaluate that expression.
    c = F.col(count).cast("bigint")
    none = F.array().cast("array<bigint>")
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    fits = (c >= 1) & (c <= chunk) if heavy else c >= 1
    few = rows.withColumn(out, F.explode(F.when(fits, F.sequence(one, c)).otherwise(none)))
    if not heavy:
        return few
    many = (rows.withColumn("_cb", F.explode(
                F.when(c > chunk, F.sequence(zero, F.ceil(c / F.lit(chunk)) - 1)).otherwise(none)))
            .repartition(_partitions(rows), *(keys or []), "_cb")
            .withColumn(out, F.explode(F.sequence(F.col("_cb") * chunk + 1,
                                                  F.least(c, (F.col("_cb") + 1) * chunk))))
            .drop("_cb"))
    return few.unionByName(many)


def _draw_key(label: str, i: str) -> Column:
    return F.concat(F.col(label).cast("string"), F.lit("/"), F.col(i).cast("string"))


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    """(label, _m): rows per class, written once."""
    return materialize(df.groupBy(label).agg(F.count(F.lit(1)).alias("_m")), "class-sizes")


def _target(sizes: DataFrame, label: str, n: int | None, majority) -> int:
    if n is not None:
        return int(n)
    return int(sizes.where(F.col(label) == F.lit(majority)).agg(F.sum("_m")).first()[0] or 0)


def rebalance(df: DataFrame, label: str = S.LABEL, key=S.KEY, n: int | None = None,
              salt: str = "boot", majority=0, resample_majority: bool = True) -> DataFrame:
    """Bootstrap every class to ``n`` rows (default: the size of class
    ``majority``), drawing with replacement, the majority class included.

    Draw i of class c picks index floor(u(c/i) * m_c) in key order; draws are
    aggregated to (class, index, copies) before meeting the rows, so the join
    carries at most one row per distinct drawn row.  ``key`` is the column or
    columns that identify a row (a table that was rebalanced before: id and
    copy); repeated keys are an error, found before anything is drawn.
    Output: input columns + ``copy`` (1..copies).  Rows whose label is NULL
    belong to no class and are not resampled.

    ``resample_majority=False`` keeps the ``majority`` class as it is (each
    row once, copy = 1) and bootstraps only the other classes to ``n``."""
    key = [key] if isinstance(key, str) else list(key)
    if not resample_majority:
        is_major = F.col(label) == F.lit(majority)
        if n is None:
            n = df.where(is_major).count()
        kept = df.where(is_major).withColumn("copy", F.lit(1).cast("bigint"))
        others = rebalance(df.where(~is_major), label, key, n, salt, majority)
        return kept.unionByName(others)
    base = df.where(F.col(label).isNotNull())
    # Index only the narrow (class, key) pairs; full rows move once, in the final join.
    kidx = dense_index(base.select(label, *key), [label], key, name="_k", repeats="_again")
    if not kidx.where("_again").isEmpty():
        raise ValueError(f"rebalance: {key} does not identify a row; name all its key columns")
    sizes = class_sizes(kidx, label)
    target = _target(sizes, label, n, majority)
    if target <= 0:
        return base.withColumn("copy", F.lit(1).cast("bigint")).limit(0)
    last = F.lit(-(-target // DRAW_CHUNK) - 1).cast("bigint")
    draws = (sizes.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
             .repartition(_partitions(df), label, "_chunk")
             .withColumn("_i", F.explode(F.sequence(
                 F.col("_chunk") * DRAW_CHUNK,
                 F.least(F.lit(target).cast("bigint"), (F.col("_chunk") + 1) * DRAW_CHUNK) - 1)))
             .select(label, F.floor(u(_draw_key(label, "_i"), salt, DRAW_DIGITS)
                                    * F.col("_m")).alias("_k"))
             .groupBy(label, "_k").agg(F.count(F.lit(1)).alias("_c")))
    # The optimizer takes the draws for as small as the class sizes they come from and would
    # broadcast them; they are as many as the rows, so both sides are shuffled and merged.
    picked = materialize(kidx.join(draws.hint("merge"), [label, "_k"]).select(label, *key, "_c"), "picked")
    on = [label, *key]
    out = expand_copies(base.join(picked, on), "_c", "copy", keys=on,
                        heavy=not picked.where(F.col("_c") > COPY_CHUNK).isEmpty())
    return out.select(*[c for c in df.columns if c != "copy"], "copy")


# Cells by which a draw finds its steps in a class' Poisson table.
DRAW_CELLS = 1 << 10


def poisson_steps(classes: DataFrame, label: str) -> DataFrame:
    """``classes(label, _lam)`` -> (label, _j, _cdf): the CDF values cdf_0..cdf_K of
    Poisson(_lam), summed in log space (no factorial overflow or exp underflow).
    K = lam + 12 sqrt(lam) + 12 leaves a tail under 1e-13; a row can get as
    many copies as its class' table is long, so the table is no larger than
    one row's output."""
    lam, j = F.col("_lam"), F.col("_j")
    upto = Window.partitionBy(label).orderBy("_j").rowsBetween(Window.unboundedPreceding, 0)
    steps = classes.withColumn("_j", F.explode(F.sequence(
        F.lit(0), F.ceil(lam + F.lit(12.0) * F.sqrt(lam) + F.lit(12.0)).cast("int"))))
    logs = F.sum(F.when(j == 0, F.lit(0.0)).otherwise(F.log(lam) - F.log(j.cast("double")))).over(upto)
    return (steps.withColumn("_p", F.exp(-lam + logs))
            .select(label, "_j", F.sum("_p").over(upto).alias("_cdf")))


def poisson_cells(steps: DataFrame, label: str) -> DataFrame:
    """(label, _cell, _under, _in): per class and cell of the draw, how many steps lie
    under the cell, and the steps inside it.  A row of draw u has as many copies as
    there are steps under u: those under its cell and those of the few in it."""
    # A draw lies in [2^-53, 1 - 2^-53]: steps under that are counted only, those over it never met.
    cdf, least = F.col("_cdf"), 2.0 ** -53
    cell = F.when(cdf < least, -1).otherwise(F.floor(cdf * F.lit(float(DRAW_CELLS)))).cast("int")
    held = (steps.where(cdf < 1.0 - least).withColumn("_cell", cell).groupBy(label, "_cell")
            .agg(F.count(F.lit(1)).alias("_n"),
                 F.sort_array(F.collect_list(F.when(F.col("_cell") >= 0, cdf))).alias("_in")))
    every = (steps.select(label).distinct()
             .withColumn("_cell", F.explode(F.sequence(F.lit(-1), F.lit(DRAW_CELLS - 1)))))
    before = Window.partitionBy(label).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    return (every.join(held, [label, "_cell"], "left")
            .select(label, "_cell", F.coalesce(F.sum(F.coalesce("_n", F.lit(0))).over(before), F.lit(0)).alias("_under"),
                    F.coalesce("_in", F.array().cast("array<double>")).alias("_in")))


def rebalance_poisson(df: DataFrame, label: str = S.LABEL, key=S.KEY,
                      n: int | None = None, salt: str = "pois", majority=0) -> DataFrame:
    """R2: approximate rebalance for very large inputs.  Each row gets a
    Poisson(n / m_class) number of copies from its own keyed draw: no index
    and no shuffle of rows; class sizes are n in expectation.

    lam is constant within a class, so the inverse CDF is a table per class; the rows
    meet it by (class, cell of the draw) and compare the one or two steps there."""
    key = [key] if isinstance(key, str) else list(key)
    base = df.where(F.col(label).isNotNull())
    sizes = class_sizes(base, label)
    target = _target(sizes, label, n, majority)
    if target <= 0:
        return base.withColumn("copy", F.lit(1).cast("bigint")).limit(0)
    classes = sizes.select(label, (F.lit(float(target)) / F.col("_m").cast("double")).alias("_lam"))
    cells = materialize(poisson_cells(poisson_steps(classes, label), label), "poisson-cells")
    most = cells.agg(F.max(F.col("_under") + F.size("_in"))).first()[0] or 0
    draw = u(row_key(key), salt, DRAW_DIGITS)
    drawn = base.withColumn("_u", draw).withColumn(
        "_cell", F.floor(F.col("_u") * F.lit(float(DRAW_CELLS))).cast("int"))
    counted = (drawn.join(cells, [label, "_cell"])
               .withColumn("_c", F.col("_under") + F.size(F.filter("_in", lambda v: v < F.col("_u"))))
               .drop("_u", "_cell", "_under", "_in"))
    out = expand_copies(counted, "_c", "copy", keys=key, heavy=most > COPY_CHUNK)
    return out.select(*[c for c in df.columns if c != "copy"], "copy")


def row_key(cols: list[str]) -> Column:
    """Text key of a row from its identifying columns (e.g. id, copy)."""
    return F.concat_ws("/", *[F.col(c).cast("string") for c in cols])


def sample_n(df: DataFrame, n: int, key: list[str] = (S.KEY,), salt: str = "sample") -> DataFrame:
    """Simple random sample of min(n, rows) rows without replacement: the
    rows with the n smallest md5(key:salt) (ties: smaller key)."""
    return (smallest_by_hash(df, [], list(key), salt, lambda m: F.lit(int(n)))
            .where("_in").drop("_in"))


def split(df: DataFrame, key: list[str] = (S.KEY,), test: float = S.TEST_FRACTION,
          salt: str = "split", out: str = "split") -> DataFrame:
    """Bernoulli train/test split (sizes approximate), column ``split``."""
    d = u(row_key(list(key)), salt)
    return df.withColumn(out, F.when(d < F.lit(1.0 - test), "train").otherwise("test"))


def stratified_split(df: DataFrame, label: str = S.LABEL, key: list[str] = (S.KEY,),
                     test: float = S.TEST_FRACTION, salt: str = "split",
                     out: str = "split") -> DataFrame:
    """Exact stratified split.  Within each class, rows ordered by
    md5(key:salt) then key; the first ceil((1 - test) * m) go to train."""
    share = F.lit(f"{1.0 - test:.12f}").cast("decimal(20,12)")
    marked = smallest_by_hash(df, [label], list(key), salt, lambda m: F.ceil(share * m))
    return marked.withColumn(out, F.when(F.col("_in"), "train").otherwise("test")).drop("_in")


def split_sizes(df: DataFrame, col: str = "split") -> DataFrame:
    """Rows per split."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def recombine(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train and test back together, duplicates kept."""
    return train.unionByName(test)
