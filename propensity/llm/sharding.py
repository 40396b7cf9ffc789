"""Contiguous, byte-balanced shards from global prefix sums (law ``bytes``).

1. Only key, byte size and checksum are kept of each row (the text is read
   once and never shuffled) and staged.
2. The narrow rows are range-partitioned and sorted; each task writes the
   running row count and byte sum *inside* its partition.
3. Totals per partition (one row each) become offsets by a prefix sum; adding
   them gives the global byte position of every row without any global sort
   in one task.
4. Shard = the equal target interval in which the row's middle byte lies, so
   shards are contiguous in key order and miss the target by less than one row.

Defined cases: a NULL text counts 0 bytes (checksum 0, that of the empty
text); NULL keys sort first; repeated rows each keep a slot of their own (ties
go by checksum, size, then a hash of the input position); an empty table gives an
empty result; fewer rows than shards leave some shards empty.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import discard, staged

ROW_OVERHEAD_BYTES = 8
_KEYS = ["doc_id", "text_crc32", "size", "_tie"]


def _running(batches):
    from pyspark import TaskContext

    import numpy as np

    part = TaskContext.get().partitionId()
    rows = total = 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        ends = np.cumsum(size) + total
        n = len(size)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("size"), batch.column("text_crc32"),
             pa.array(np.full(n, part), pa.int32()),
             pa.array(np.arange(rows, rows + n), pa.int64()),
             pa.array(ends - size, pa.int64())],
            names=["doc_id", "size", "text_crc32", "_part", "_row", "_before"])
        rows += n
        total = int(ends[-1]) if n else total


def assign_shards(docs: DataFrame, n_shards: int = 24, key: str = "doc_id",
                  text: str = "text") -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    narrow, narrow_path = staged(
        docs.select(F.col(f"`{key}`").alias("doc_id"),
                    (F.octet_length(body) + ROW_OVERHEAD_BYTES).cast("long").alias("size"),
                    F.crc32(body.cast("binary")).alias("text_crc32"),
                    F.xxhash64(F.monotonically_increasing_id()).alias("_tie")), "shard-sizes")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    placed, _ = staged(
        narrow.repartitionByRange(*[F.col(c) for c in _KEYS]).sortWithinPartitions(*_KEYS)
        .mapInArrow(_running, f"doc_id {kind}, size long, text_crc32 long, _part int, "
                              "_row long, _before long"), "shard-places")
    discard(spark, narrow_path)
    # One row per range partition: the prefix sum over them is a small window.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (placed.groupBy("_part").agg(F.count("*").alias("_n"), F.sum("size").alias("_b"))
               .select("_part",
                       F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows0"),
                       F.coalesce(F.sum("_b").over(earlier), F.lit(0)).alias("_bytes0"),
                       F.sum("_b").over(everything).alias("_total")))
    ranked = placed.join(offsets, "_part").select(
        "doc_id", "size", "text_crc32",
        (F.col("_rows0") + F.col("_row")).alias("_global"),
        F.expr(f"(({n_shards} * (2 * (_bytes0 + _before) + size)) div (2 * _total))")
        .cast("int").alias("shard"))
    firsts = ranked.groupBy("shard").agg(F.min("_global").alias("_first"))  # n_shards rows
    return ranked.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_global") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
