"""Toxicity: FTRL-proximal logistic regression over hashed word features.

Features of a text are the *distinct* hashed word unigrams, bigrams and
skip-grams (two words with one between) of its lower-cased words, each with
value 1.  FTRL-proximal keeps a gradient sum and a squared-gradient sum per
coordinate: every coordinate has its own learning rate, and L1 leaves a
coordinate at exactly zero until its evidence exceeds the penalty, so the
fitted model is a short list of (coordinate, weight), at most ``DIMENSIONS``.

Training reads a bounded sample of the labelled rows (``max_rows`` and
``TRAIN_FEATURES``, smallest key hashes first, so the choice does not depend on
layout): features are hashed in parallel, repeated rows of a key are reduced to one
before they are exchanged, and one bounded task runs the online passes.  Scoring is
map-only over whole texts with the broadcast weights.

Defined cases: NULL or wordless text scores the intercept; labels that are
NULL or without a document teach nothing; several labels of one document count
as their majority (a tie: toxic); without any usable label every score is 0.
Scores use the text alone, never the key, language, source or label.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import unit_hash

BITS = 18
DIMENSIONS = 1 << BITS          # bound of the model: 2^18 coordinates
TRAIN_ROWS = 16_384             # bounds of the labelled sample: rows,
TRAIN_FEATURES = 1 << 26        # and distinct features in all (256 MB)
# Chosen by accuracy on an inner fold (crc32 mod 5 = 1) of the training rows alone.
ALPHA, BETA, L1, L2, EPOCHS = 1.0, 1.0, 6.0, 0.0, 3
_WORD = re.compile(rb"[0-9A-Za-z_\x80-\xff]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def features(text: str | None) -> np.ndarray:
    """Hashed coordinates of one text, repeats included."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    word = np.fromiter(map(zlib.crc32, _WORD.findall(raw)), np.uint64)
    left, right = word * _MIX, (word + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
    grams = np.concatenate([
        word,
        (left[:-1] ^ (right[1:] >> np.uint64(7))) + np.uint64(2),
        (left[:-2] ^ (right[2:] >> np.uint64(11))) + np.uint64(3)])
    return ((grams * _MIX) >> np.uint64(64 - BITS)).astype(np.uint32)


def ftrl(examples, labels, epochs=EPOCHS, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
    """Online passes; returns (intercept, coordinates, weights)."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weight(i):
        zi = z[i]
        penalty = np.where(i == DIMENSIONS, 0.0, l1)     # the intercept is not penalised
        return np.where(np.abs(zi) <= penalty, 0.0,
                        -(zi - np.sign(zi) * penalty) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for index, label in zip(examples, labels):
            index = np.append(index, DIMENSIONS).astype(np.int64)
            w = weight(index)
            gradient = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, w.sum())))) - label
            rate = (np.sqrt(n[index] + gradient * gradient) - np.sqrt(n[index])) / alpha
            z[index] += gradient - rate * w
            n[index] += gradient * gradient
    w = weight(np.arange(DIMENSIONS + 1))
    kept = np.flatnonzero(w[:-1])
    return float(w[-1]), kept.astype(np.int64), w[kept]


def _hash_batches(batches):
    for batch in batches:
        index = [np.unique(features(t.as_py())).tobytes() for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("order"), batch.column("key"), batch.column("label"),
             pa.array(index, pa.binary())], names=["order", "key", "label", "index"])


def _train_batches(batches):
    examples, labels, held = [], [], 0
    for batch in batches:
        for label, index in zip(*(batch.column(c).to_pylist() for c in ("label", "index"))):
            held += len(index) // 4
            if held > TRAIN_FEATURES:
                break
            examples.append(np.frombuffer(index, np.uint32))
            labels.append(label)
        if held > TRAIN_FEATURES:
            break
    if not labels:
        return
    intercept, index, weight = ftrl(examples, labels)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(index, -1), pa.int64()), pa.array(np.append(weight, intercept))],
        names=["index", "weight"])


def fit(docs: DataFrame, labels: DataFrame, allowed: Column, key: str = "doc_id",
        text: str = "text", label: str = "toxic", max_rows: int = TRAIN_ROWS):
    """Fit on labelled rows for which ``allowed`` (over the label's key, named
    ``key``) holds.  Returns (intercept, coordinates, weights) or None."""
    chosen = (labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"))
              .where(F.col("key").isNotNull() & F.col("label").isNotNull()).where(allowed)
              .groupBy("key").agg((F.avg("label") >= 0.5).cast("double").alias("label"))
              .select(F.xxhash64(F.col("key").cast("string")).alias("order"), "key", "label")
              .orderBy("order", "key").limit(max_rows))
    rows = (docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
            .join(F.broadcast(chosen), "key")          # at most max_rows rows
            .select("order", "key", "label", "text"))
    kind = rows.schema["key"].dataType.simpleString()
    model = (rows.mapInArrow(_hash_batches, f"order long, key {kind}, label double, index binary")
             .groupBy("order", "key", "label").agg(F.min("index").alias("index"))   # one row a key
             .repartition(1).sortWithinPartitions("order", "key")
             .mapInArrow(_train_batches, "index long, weight double").toPandas())
    if model.empty:
        return None
    intercept = model.loc[model["index"] < 0, "weight"].iloc[0]
    model = model[model["index"] >= 0]
    return float(intercept), model["index"].to_numpy(), model["weight"].to_numpy()


def _scorer(spark, model):
    if model is None:
        return lambda texts: np.zeros(len(texts))
    intercept, index, weight = model
    dense = np.zeros(DIMENSIONS)
    dense[index] = weight
    shared = spark.sparkContext.broadcast(dense)       # 2 MB whatever the corpus

    def score(texts):
        weights = shared.value
        out = np.empty(len(texts))
        for row, text in enumerate(texts):
            index = features(text.as_py())
            index = np.unique(index[weights[index] != 0])
            total = intercept + weights[index].sum()
            out[row] = 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, total))))
        return out
    return score


def score(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row."""
    scorer = _scorer(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scorer(batch.column(1)))], names=["key", "score"])
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, score double")


def reject(docs: DataFrame, model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more (map-only)."""
    scorer = _scorer(docs.sparkSession, model)

    def run(batches):
        for batch in batches:
            keep = scorer(batch.column(batch.schema.get_field_index(text))) < threshold
            yield batch.filter(pa.array(keep))
    return docs.mapInArrow(run, docs.schema)


def trainable(column: Column, folds: int = 5, held_out: int = 0) -> Column:
    return unit_hash(column, folds) != held_out
