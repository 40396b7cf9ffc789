"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensity.session import ensure_checkpoint_dir, scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor later re-reads files instead of
    recomputing shuffles.  Returns the reread frame and its path.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"{label}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a staged table through the file system its path names."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(hadoop_path, True)


MAX_BROADCAST_ROWS = 1 << 20
MAX_BROADCAST_BYTES = 64 << 20


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """Estimated size of one value in memory, arrays, maps and structs included."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 16
    elif isinstance(kind, T.StructType):
        size = F.lit(16)
        for f in kind.fields:
            size = size + value_bytes(value.getField(f.name), f.dataType)
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
            size = F.aggregate(value, F.lit(24).cast("long"),
                               lambda total, x: total + value_bytes(x, kind.elementType))
        else:
            size = F.size(value) * 8 + 24
    elif isinstance(kind, T.MapType):
        size = (value_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
                + value_bytes(F.map_values(value), T.ArrayType(kind.valueType)))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def bounded_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A broadcast hint only if the (staged, narrow) table was measured to hold at
    most ``MAX_BROADCAST_ROWS`` rows and ``MAX_BROADCAST_BYTES`` bytes; beyond that
    the join is left to Spark.  A caller that knows the rows of a table of fixed-width
    columns passes their number."""
    if rows is None:
        fields = df.schema.fields
        width = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in fields), F.lit(16))
        rows, size = df.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
        if size > MAX_BROADCAST_BYTES:
            return df
    return F.broadcast(df) if rows <= MAX_BROADCAST_ROWS else df


def unit_hash(column: Column, modulus: int) -> Column:
    """crc32 of a key's text form modulo ``modulus`` (a NULL key counts as '')."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def row_fingerprint(df: DataFrame) -> Column:
    """A 64-bit hash over every column: equal rows get equal values."""
    def hashable(field):
        column = F.col(f"`{field.name}`")
        return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column
    return F.xxhash64(*[hashable(f) for f in df.schema.fields])
