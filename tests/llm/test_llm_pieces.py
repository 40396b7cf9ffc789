"""SentencePiece: segments beyond the broadcast head are solved where they lie."""

import random

import pytest
from pyspark.sql import functions as F

from propensity.llm import pieces
from test_llm_text import slow_viterbi


@pytest.fixture(scope="module")
def model_file():
    return pytest.importorskip("public_tokenizers").path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def table(model_file):
    return pieces.PieceTable(model_file)


def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)


def ids_of(docs, model_file):
    return {r.key: r.ids for r in pieces.encode(docs, model_file, F.col("doc_id")).collect()}


def rare_texts(n=30):
    rng = random.Random(11)
    return [" ".join("".join(rng.choices(["th", "an", "er", "ß", "9", "Q", "日", "_"], k=rng.randint(1, 9)))
                     for _ in range(40)) for _ in range(n)]


def test_solver_equals_viterbi(table):
    solver = pieces._Solver(table.usable, table.lens(), table.unknown, table.byte_ids)
    for text in [*rare_texts(), "", "  ", "▁ x", "the the", "e" * 5000]:
        assert solver(" " + text).tolist() == slow_viterbi(text, table)


def test_rare_segments_need_no_shuffle_and_no_table(spark, model_file, table, monkeypatch):
    docs = corpus(spark, rare_texts())
    monkeypatch.setattr(pieces, "KEPT", 20)
    monkeypatch.setattr(pieces, "COMBINED", 50)
    segments = pieces.segment_table(docs, table)
    assert 0 < segments.count() <= 20
    found = pieces.encode_digest(docs, model_file, F.col("doc_id"), keep_ids=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "segment" not in plan
    rows = found.collect()
    assert len(rows) == 30 and all(r.round_trip for r in rows)
    texts = rare_texts()
    assert all(r.ids == slow_viterbi(texts[r.key], table) for r in rows)


def test_long_segments_stay_out_of_the_table(spark, model_file, table, monkeypatch):
    docs = corpus(spark, ["x" * 90 + " and", "and and"])
    monkeypatch.setattr(pieces, "LONGEST", 40)
    assert max(len(r.seg) for r in pieces.segment_table(docs, table).collect()) <= 40
    assert ids_of(docs, model_file)[0] == slow_viterbi("x" * 90 + " and", table)


def test_segment_that_shares_a_head_hash_is_not_taken_for_it(spark, model_file, table, monkeypatch):
    texts = ["stop stop stop stop", "the post", "pots", "xyz stop"]
    docs = corpus(spark, texts)
    monkeypatch.setattr(pieces, "_ROOT", 1)                  # the hash of all anagrams is one
    monkeypatch.setattr(pieces, "KEPT", 1)                   # " stop" alone is in the head
    assert [r.seg for r in pieces.segment_table(docs, table).collect()] == [" stop"]
    assert ids_of(docs, model_file) == {i: slow_viterbi(t, table) for i, t in enumerate(texts)}
    assert all(r.round_trip for r in pieces.encode_digest(docs, model_file, F.col("doc_id")).collect())
