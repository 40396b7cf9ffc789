"""Language identification with a blended-spectrum string kernel.

A text's spectrum is the set of its character n-grams (orders 1 to 4, over
lower-cased letters with every other run as one space), hashed to ``SPACE``
buckets; the kernel of two texts is the size of the intersection over the
geometric mean of the sizes (n-gram *presence*, not counts).

Nystroem: ``landmarks`` training texts give the small kernel matrix; its
inverse square root maps a text's kernel row to features in which one ridge
regression per language (one versus rest) is solved.  Both maps fold into one
coefficient matrix, so scoring is two matrix products per batch: presence
rows times landmark columns, then times coefficients.

Training uses a bounded, language-stratified sample (``max_rows``, by key
hash); only kernel rows (max_rows x landmarks numbers) reach the driver.

Defined cases: NULL text or no letter: ``und`` with score 0; rows with NULL
lang teach nothing; nothing to learn from: ``und`` everywhere; ties go to the
language that sorts first; repeated rows are scored alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE_BITS = 13
SPACE = 1 << SPACE_BITS
ORDERS = (1, 2, 3, 4)
LANDMARKS = 128
TRAIN_ROWS = 8_192
RIDGE = 1e-2
_BATCH = 256
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F,
                               0x165667B19E3779F9, 0x27D4EB2F165667C5)]


class Spectrum:
    """Presence rows of texts; remembers which code points are letters."""

    def __init__(self):
        self.letter = np.full(0x110000, -1, np.int8)

    def letters(self, text: str | None) -> np.ndarray:
        code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        known = self.letter[code]
        if (known < 0).any():
            for c in np.unique(code[known < 0]).tolist():
                self.letter[c] = chr(c).isalpha()
            known = self.letter[code]
        is_letter = known > 0
        if not is_letter.any():
            return np.empty(0, np.uint64)
        first = np.concatenate([[False], is_letter[:-1]])
        return np.where(is_letter, code, 32)[is_letter | first].astype(np.uint64)

    def fill(self, row: np.ndarray, text: str | None) -> bool:
        """Mark the text's buckets in ``row``; False if it has no letter."""
        code = self.letters(text)
        if not len(code):
            return False
        gram = np.zeros(len(code), np.uint64)
        for order in ORDERS:
            if len(code) < order:
                break
            gram = gram[:len(code) - order + 1] * _ODD[3] + code[order - 1:] * _ODD[order - 1]
            row[(gram * _ODD[0]) >> np.uint64(64 - SPACE_BITS)] = 1.0
        return True

    def rows(self, texts) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((len(texts), SPACE), np.float32)
        some = np.array([self.fill(out[i], t) for i, t in enumerate(texts)], bool)
        return out, some


def kernel(rows: np.ndarray, marks: np.ndarray, mark_sizes: np.ndarray) -> np.ndarray:
    """``marks``: buckets x landmarks."""
    sizes = rows.sum(axis=1)
    return (rows @ marks) / np.sqrt(np.maximum(sizes, 1)[:, None] * mark_sizes[None, :])


def _kernel_rows(marks, sizes):
    def run(batches):
        spectrum = Spectrum()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), _BATCH):
                part = batch.slice(at, _BATCH)
                rows, some = spectrum.rows(texts[at:at + _BATCH])
                values = kernel(rows, marks.value, sizes.value).astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("order"), part.column("lang"), pa.array(some),
                     pa.array([v.tobytes() for v in values], pa.binary())],
                    names=["order", "lang", "some", "kernel"])
    return run


def fit(docs: DataFrame, allowed: Column, key: str = "doc_id", text: str = "text",
        lang: str = "lang", landmarks: int = LANDMARKS, max_rows: int = TRAIN_ROWS,
        ridge: float = RIDGE):
    """Fit on rows whose key passes ``allowed`` (a condition over column
    ``key``).  Returns (languages, landmark matrix, sizes, coefficients) or None."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").alias("lang"),
                       F.col(f"`{text}`").alias("text")).where(allowed).where("lang is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    langs = sorted(counts)
    quota = max(1, max_rows // len(langs))
    # Rate per language, twice the quota where there are that many rows; then the exact quota.
    rates = spark.createDataFrame([(k, min(1.0, 2.0 * quota / n)) for k, n in counts.items()],
                                  "lang string, rate double")
    order = F.xxhash64(F.col("key").cast("string"), F.lit("language"))
    ranked = Window.partitionBy("lang").orderBy("order", F.xxhash64("text"))
    sample = (rows.select("lang", "text", order.alias("order")).join(F.broadcast(rates), "lang")
              .where((F.col("order") / F.lit(2.0 ** 64) + 0.5) <= F.col("rate"))
              .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= quota)
              .select("order", "lang", "rank", "text").persist())
    try:
        per_lang = max(1, landmarks // len(langs))
        mark_rows = (sample.where(F.length(F.trim("text")) > 0).where(F.col("rank") <= per_lang)
                     .select("lang", "rank", "order", "text").toPandas()
                     .sort_values(["lang", "rank", "order"], kind="stable"))
        found, some = Spectrum().rows(mark_rows["text"].tolist())
        found = found[some]
        if not len(found):
            return None
        marks, sizes = np.ascontiguousarray(found.T), found.sum(axis=1)
        context = spark.sparkContext
        shared = context.broadcast(marks), context.broadcast(sizes)
        table = (sample.select("order", "lang", "text")
                 .mapInArrow(_kernel_rows(*shared), "order long, lang string, some boolean, "
                                                    "kernel binary").toPandas())
    finally:
        sample.unpersist()
    table = table[table["some"]].sort_values(["lang", "order", "kernel"], kind="stable")
    if table.empty:
        return None
    k_rows = np.frombuffer(b"".join(table["kernel"]), np.float64).reshape(len(table), -1)
    values, vectors = np.linalg.eigh(kernel(found, marks, sizes).astype(np.float64))
    keep = values > 1e-6 * values.max()
    whiten = vectors[:, keep] / np.sqrt(values[keep])
    mapped = k_rows @ whiten
    targets = (table["lang"].to_numpy()[:, None] == np.array(langs)[None, :]).astype(np.float64)
    gram = mapped.T @ mapped + ridge * len(mapped) / 100 * np.eye(mapped.shape[1])
    return langs, marks, sizes, whiten @ np.linalg.solve(gram, mapped.T @ targets)


def predict(docs: DataFrame, model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) for every row."""
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    if model is None:
        return rows.select("key", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    langs, *arrays = model
    shared = docs.sparkSession.sparkContext.broadcast(arrays)   # landmarks x buckets: bounded
    names = np.array([*langs, "und"], object)

    def run(batches):
        spectrum = Spectrum()
        marks, sizes, coefficients = shared.value
        for batch in batches:
            texts = batch.column("text")
            for at in range(0, len(texts), _BATCH):
                part = texts.slice(at, _BATCH).to_pylist()
                presence, some = spectrum.rows(part)
                values = kernel(presence, marks, sizes) @ coefficients
                best = np.where(some, values.argmax(axis=1), len(langs))
                score = np.where(some, np.clip(values.max(axis=1), 0.0, 1.0), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(at, _BATCH), pa.array(names[best], pa.string()),
                     pa.array(score, pa.float64())], names=["key", "lang_pred", "score"])
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double")
