"""Registered queries of the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from propensity.llm import (ann, decontam, html_text, langid, mixing, negatives, pieces,
                            repair, secrets, sharding, simhash, tokenfile, toxicity)
from propensity.llm import oracles
from propensity.llm.common import table, unit_hash
from propensity.session import ensure_checkpoint_dir, scratch_path


def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"),
                         toxicity.trainable(F.col("key"), folds=5, held_out=0))
    return toxicity.score(docs, model).select(
        F.col("key").alias("doc_id"), (unit_hash(F.col("key"), 5) == 0).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_sentencepiece(spark, sf_dir, model_file=None):
    import public_tokenizers

    model_file = model_file or public_tokenizers.path("piece_bpe_32k.model")
    return (pieces.encode_digest(table(spark, sf_dir, "documents"), model_file, F.col("doc_id"))
            .withColumnRenamed("key", "doc_id"))


def op3_decontamination(spark, sf_dir):
    found = decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("uid.id").alias("doc_id"), F.col("item").alias("item_id"),
                        F.col("start").alias("start_word"), "similarity")


def op4_nearest_neighbours(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op5_secret_scan(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents"), F.col("doc_id"), owner="source")
    return found.select(
        F.col("key").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256",
        secrets.span_list(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda f: f["live"])).alias("n_live"),
        F.size(F.filter("found", lambda f: ~f["live"])).alias("n_example"))


def op6_sharding(spark, sf_dir):
    return sharding.assign_shards(table(spark, sf_dir, "documents"), n_shards=24)


def op7_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs, unit_hash(F.col("key"), 4) != 2)
    return langid.predict(docs, model).select(
        F.col("key").alias("doc_id"), (unit_hash(F.col("key"), 4) == 2).alias("held_out"),
        "lang_pred", "score")


def op8_html_extraction(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), F.col("doc_id"),
                                    shingle=3, max_bits=3)
    return found.select(F.col("key").alias("doc_id"), simhash.hex16("fp").alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op10_token_binary(spark, sf_dir, tokenizer_file=None):
    import public_tokenizers

    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, f"token-files-{uuid.uuid4().hex}")
    tokenfile.write_token_files(
        table(spark, sf_dir, "documents"),
        tokenizer_file or public_tokenizers.path("byte_bpe_50k.json"), path, end_id=0)
    return tokenfile.read_token_files(spark, path, digest=True)


def op11_conversation_repair(spark, sf_dir):
    damaged = repair.damage(table(spark, sf_dir, "conversations"))
    return repair.report(damaged, absent=F.col("dropped"))


def op12_hard_negatives(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.expr(
        "if(vec_id % 7 = 0, (cast(label as bigint) + 1) % 10, cast(label as bigint))").alias("label"))
    return negatives.mine(rows, F.col("vec_id") % 50 == 0, positives=5, negatives=3, low=50, high=95)


def op13_mixing(spark, sf_dir):
    return mixing.allot(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, epochs=2).select(
        "doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_decontamination": op3_decontamination,
    "op4_nearest_neighbours": op4_nearest_neighbours,
    "op5_secret_scan": op5_secret_scan,
    "op6_sharding": op6_sharding,
    "op7_language_id": op7_language_id,
    "op8_html_extraction": op8_html_extraction,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_token_binary": op10_token_binary,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_mixing": op13_mixing,
}
ORACLES: dict[str, str] = {
    "op12_hard_negatives": oracles.HARD_NEGATIVES,
    "op13_mixing": oracles.MIXING,
}
