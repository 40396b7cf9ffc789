"""Mixing sources to target weights: hash-random order, prefix sums, exact cuts.

1. Size: words (``[^\\x20\\x09-\\x0D]+``) of every whole text; only key, source,
   size and the hash-random key (md5 of id, salt and text) of a row are staged.
2. Targets: the sources share ``share`` times all words by weight.  No source gets
   more than ``epochs`` times its own words; the excess is shared again by weight
   among the rest until no source is above.  Each round of that is one aggregate
   over the table of sources; only its two sums reach the driver.
3. Rows are range-partitioned and sorted by (source, hash): a source with a third
   of all rows spreads over many tasks.  Each task writes the running word count;
   the totals per (source, partition) become offsets by a prefix sum.
4. A source's budget (its target, whole words) gives all its documents as many
   whole copies as fit, and the rest of it the first documents in hash order; the
   document in which the budget ends is taken up to that word.

The order depends on ids and texts alone, so reruns and other layouts agree.

Defined cases: a NULL text has 0 words; a NULL source is a source of its own, last
in order; NULL ids are ordinary values; rows equal in id, source and text are
interchangeable; documents without words are taken 0 times; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import discard, staged
from propensity.operators.sampling import dense_index

WORD = r"[^\x20\x09-\x0D]+"
WORD_RUN = WORD + r"[\x20\x09-\x0D]*"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float] | DataFrame, share: float,
            epochs: int) -> DataFrame:
    """``sizes(source, source_size)`` -> with ``target``.

    ``weights``: a cycle dealt to the sources in code point order, NULL last, or a
    table (source, weight); a source missing there weighs 0.
    """
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("_w"))
        weighed = (sizes.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
                   .withColumn("_w", F.coalesce("_w", F.lit(0.0))))
    else:
        cycle = F.array(*[F.lit(float(w)) for w in weights])
        ranked = dense_index(sizes, [], [F.col("source").isNull(), "source"], name="_rank")
        weighed = ranked.withColumn("_w", F.element_at(
            cycle, (F.col("_rank") % len(weights) + 1).cast("int"))).drop("_rank")
    weighed, _ = staged(weighed.withColumn("_cap", F.col("source_size") * epochs), "mix-sources")
    whole = weighed.agg(F.sum("source_size").alias("s"), F.sum("_w").alias("w")).first()
    budget, level, capped = share * (whole["s"] or 0), 0.0, 0
    if whole["w"]:
        level = budget / whole["w"]
    while True:
        above = F.col("_w") * F.lit(level) > F.col("_cap")
        now = weighed.agg(F.count_if(above).alias("n"),
                          F.coalesce(F.sum(F.when(above, F.col("_cap"))), F.lit(0)).alias("fixed"),
                          F.coalesce(F.sum(F.when(~above, F.col("_w"))), F.lit(0.0)).alias("free")).first()
        if now["n"] == capped or not now["free"]:
            break
        capped, level = now["n"], (budget - now["fixed"]) / now["free"]
    return weighed.select("source", "source_size", F.when(above, F.col("_cap").cast("double"))
                          .otherwise(F.col("_w") * F.lit(level)).alias("target"))


def _running(batches):
    """Adds the partition number and the words before each row in it."""
    from pyspark import TaskContext

    import numpy as np

    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        ends = np.cumsum(size) + total
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(size), part), pa.int32()),
             pa.array(ends - size, pa.int64())],
            names=[*batch.schema.names, "_part", "_before"])
        total = int(ends[-1]) if len(size) else total


def allot(docs: DataFrame, weights: Sequence[float] | DataFrame = (1.0,), share: float = 1.0,
          epochs: int = 2, key: str = "doc_id", source: str = "source", text: str = "text",
          salt: str = "mix", row: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies (whole
    ones), tail (first words of one more copy), taken (words in all).  ``row`` names a
    column of ``docs`` to carry along."""
    spark = docs.sparkSession
    body, name = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    extra = [F.col(f"`{row}`").alias("_row")] if row else []
    narrow, narrow_path = staged(docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), words(body).alias("size"),
        F.md5(F.concat(name, F.lit(f":{salt}:"), body)).alias("_h"),
        F.monotonically_increasing_id().alias("_tie"), *extra), "mix-rows")
    sizes, _ = staged(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    shares, _ = staged(targets(sizes, weights, share, epochs), "mix-targets")
    order = [F.col("source").isNull(), F.col("source"), F.col("_h"), F.col("_tie")]
    kept = ["doc_id", "source", "size", *(["_row"] if row else [])]
    kinds = ", ".join(f"{c} {narrow.schema[c].dataType.simpleString()}" for c in kept)
    placed, _ = staged(narrow.repartitionByRange(*order).sortWithinPartitions(*order)
                       .select(*kept).mapInArrow(_running, f"{kinds}, _part int, _before long"), "mix-places")
    discard(spark, narrow_path)
    # One row per source and partition that holds some of it.
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy("source", "_part").agg(F.sum("size").alias("_n"), F.min("_before").alias("_first"))
    runs = runs.withColumn("_shift", F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first"))
    budget = F.floor("target").cast("long")
    full = F.when(F.col("source_size") > 0, F.expr("floor(target) div source_size")).otherwise(0)
    of_source = shares.select(F.col("source").alias("_s"), "source_size", "target", full.alias("_full"),
                              (budget - full * F.col("source_size")).alias("_rest"))
    runs = (runs.join(of_source, F.col("source").eqNullSafe(F.col("_s")))
            .select("_s", F.col("_part").alias("_p"), "_shift", "source_size", "target", "_full", "_rest"))
    at = F.col("_before") + F.col("_shift")
    partly = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("_rest") - at))
    whole = (F.col("size") > 0) & (partly == F.col("size"))
    return (placed.join(runs, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
            .select("doc_id", "source", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.col("_full") + whole.cast("long")).otherwise(0).alias("copies"),
                    F.when(whole, 0).otherwise(partly).alias("tail"),
                    (F.col("_full") * F.col("size") + partly).alias("taken"),
                    *([F.col("_row").alias(row)] if row else [])))


def mixed(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, numbered by
    ``epoch`` from 1; the last copy of a document that a budget cuts holds its first
    words only."""
    spread, _ = staged(docs.withColumn("_mix_row", F.monotonically_increasing_id()), "mix-docs")
    plan = (allot(spread, text=text, row="_mix_row", **options)
            .select("_mix_row", F.col("copies").alias("_copies"), F.col("tail").alias("_tail")))
    every = F.col("_copies") + F.when(F.col("_tail") > 0, 1).otherwise(0)
    body = F.col(f"`{text}`")
    cut = F.regexp_substr(body, F.concat(F.lit(r"^[\x20\x09-\x0D]*+(?:" + WORD_RUN + "){"),
                                         F.col("_tail").cast("string"), F.lit("}")))
    return (spread.join(plan, "_mix_row")
            .withColumn("epoch", F.explode(F.when(every > 0, F.sequence(F.lit(1).cast("long"), every))
                                           .otherwise(F.array().cast("array<bigint>"))))
            .withColumn(text, F.when(F.col("epoch") <= F.col("_copies"), body).otherwise(cut))
            .drop("_mix_row", "_copies", "_tail"))
