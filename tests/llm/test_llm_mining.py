"""Conversation repair, hard negatives and mixing against plain versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from propensity.llm import gnat, mixing, negatives, oracles, queries, repair
from test_llm_text import SF

SPACE = " \t\n\x0b\x0c\r"


# ---------------------------------------------------------------- repair

def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = " " if conv is None else str(conv), " " if turn is None else str(turn)
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub(r"[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def plain_faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_repair(rows, faults):
    """Cheapest (cost, audit, lines) by tables over rows, all edits tried."""
    n = len(rows)
    best = [{} for _ in range(n + 1)]
    best[0][""] = (0, "", ())

    def offer(i, state, value):
        if state not in best[i] or value[:2] < best[i][state][:2]:
            best[i][state] = value
            return True
        return False

    for i in range(n + 1):
        todo = list(best[i])
        while todo:
            state = todo.pop()
            cost, audit, lines = best[i][state]
            for initial, name in (("u", "user"), ("a", "assistant")):
                to = AFTER.get((state, initial))
                if to and offer(i, to, (cost + 2, audit + "I", lines + (name + ":",))):
                    todo.append(to)
        if i == n:
            break
        role, text, what = rows[i][2], rows[i][3], faults[i]
        for state, (cost, audit, lines) in list(best[i].items()):
            offer(i + 1, state, (cost + 3, audit + "D", lines))
            if what in ("blank", "duplicate"):
                continue
            extra = what == "truncated"
            to = AFTER.get((state, role[:1]))
            if to:
                offer(i + 1, to, (cost + extra, audit + "K", lines + (f"{role}:{text}",)))
            for initial, name in (("u", "user"), ("a", "assistant")):
                to = AFTER.get((state, initial))
                if to:
                    offer(i + 1, to, (cost + extra + 2, audit + "R", lines + (f"{name}:{text}",)))
    cost, audit, lines = min((best[n][s] for s in ("", "a") if s in best[n]), key=lambda v: v[:2])
    return cost, audit, lines


def plain_report(rows):
    convs = defaultdict(list)
    for row in rows:
        convs[row[0]]
    for row in plain_damage(rows):
        convs[row[0]].append(row)
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults = Counter(all_faults := plain_faults(own))
        turns = [r[1] for r in own if r[1] is not None]
        illegal = sum((a[2][:1] or " ") + (b[2][:1] or " ") not in ("su", "ua", "au")
                      for a, b in itertools.pairwise(own))
        cost, audit, lines = plain_repair(own, all_faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"],
                     faults["duplicate"], faults["truncated"], illegal, cost, audit,
                     hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


CONV = "conv_id long, turn long, role string, text string"


def run_report(spark, rows, schema=CONV):
    got = repair.report(repair.damage(spark.createDataFrame(rows, schema)), absent=F.col("dropped")).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r[0]: tuple(r[1:]) for r in got}


def random_rows(seed, convs, most):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "u", "alt"]
    texts = ["Fine.", "Fine.", "Why?", "no end", " ", "", None, " ", "Eh!\n", "a.b", "x"]
    return [(c, rng.choice([t, t, t, None, t // 2]), rng.choice(roles), rng.choice(texts))
            for c in range(convs) for t in range(rng.randint(1, most))]


def test_repair_query_equals_plain(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in queries.op11_conversation_repair(spark, SF).collect()}
    assert got == plain_report(rows)


def test_repair_of_random_conversations(spark):
    rows = random_rows(1, 400, 12) + random_rows(2, 3, 90)
    rows += [(None, 1, "user", "Hi."), (None, 0, "assistant", "Yes."), (None, None, None, None)]
    assert run_report(spark, rows) == plain_report(rows)


def test_agenda_equals_tables_on_every_short_conversation():
    kinds = [("user", "A."), ("assistant", "B."), ("system", "C."), ("tool", "D."), ("user", "a"), ("user", "")]
    for size in range(5):
        for own in itertools.product(kinds, repeat=size):
            rows = [(0, i, role, f"{text[:1]}{i}{text[1:]}" if text else "") for i, (role, text) in enumerate(own)]
            faults = plain_faults(rows)
            code = {"": 0, "truncated": 1, "blank": 2, "duplicate": 3}
            found = repair.lightest([(r[2][:1], code[f]) for r, f in zip(rows, faults)], [(0, "", 0)], repair.GOALS)
            (cost, audit, _, _), = found.values()
            assert (cost, audit) == plain_repair(rows, faults)[:2]
            lines = [f"{role}:{text}" for _, role, text in repair.apply_edits([r[2:] for r in rows], 0, audit)]
            assert tuple(lines) == plain_repair(rows, faults)[2]


@pytest.mark.parametrize("segment", [1, 2, 7])
def test_segments_do_not_show(spark, monkeypatch, segment):
    rows = random_rows(3, 20, 40)
    monkeypatch.setattr(repair, "SEGMENT_ROWS", segment)
    assert run_report(spark, rows) == plain_report(rows)


def test_repaired_turns(spark):
    rows = random_rows(4, 60, 10)
    damaged = repair.damage(spark.createDataFrame(rows, CONV))
    got = defaultdict(list)
    for r in repair.repair(damaged, absent=F.col("dropped")).orderBy("conv_id", "position").collect():
        got[r.conv_id].append((r.position, r.edit, f"{r.role}:{r.text}"))
    for conv, report in plain_report(rows).items():
        own = got[conv]
        assert [p for p, _, _ in own] == list(range(len(own)))
        assert "".join(e for _, e, _ in own) == report[6].replace("D", "")
        assert hashlib.sha256("\n".join(t for _, _, t in own).encode()).hexdigest() == report[7]


def test_repair_edges(spark):
    assert run_report(spark, []) == {}
    long_text = "word " * 200_000 + "end."
    rows = [(1, 0, "user", long_text), (1, 1, "assistant", "Ok."), (2, None, None, None)] + [(3, 5, "user", "Hi.")] * 40
    assert run_report(spark, rows) == plain_report(rows)
    wide = [(c, t, r, x, True, "z") for c, t, r, x in rows]
    assert run_report(spark, wide, CONV + ", _gone boolean, _kind string") == plain_report(rows)


# ---------------------------------------------------------------- hard negatives

VECTORS = "vec_id long, embedding array<float>, label int"


def plain_mine(rows, anchors, positives=5, negatives_=3):
    clean = {}
    for key, vector, label in rows:
        if key is None or label is None or vector is None or None in vector or not np.isfinite(vector).all():
            continue
        clean[(key, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in vector))] = True
    clean, out = list(clean), []
    for a in clean:
        if a[0] % anchors:
            continue
        score = lambda r: sum(x * y for x, y in zip(a[2], r[2]))
        others = [(-score(r), r[0], r[1], r) for r in clean if r != a and len(r[2]) == len(a[2])]
        for s, key, _, row in sorted([o for o in others if o[2] == a[1]], key=lambda o: o[:2])[:positives]:
            fits = sorted([o for o in others if o[2] != a[1] and 50 * -s <= 100 * -o[0] <= 95 * -s], key=lambda o: o[:2])
            out += [(a[0], key, i + 1, o[1], -s, -o[0]) for i, o in enumerate(fits[:negatives_])]
    return sorted(out)


def mined(df, anchors):
    return sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % anchors == 0).collect())


def vector_rows(seed, n, dim, labels=4, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    x = (centres[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, dim))) * np.exp(rng.normal(size=(n, 1)) / 2)
    return [(i, [float(v) for v in x[i].astype(np.float32)], int(rng.integers(0, labels))) for i in range(n)]


def test_hard_negatives_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(oracles.HARD_NEGATIVES).fetchall()
    assert sorted(tuple(r) for r in queries.op12_hard_negatives(spark, SF).collect()) == sorted(want) and want


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_hard_negatives_over_many_shards(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "SHARD_LEAST", 40)
    rows = vector_rows(5, 400, 6, spread=spread)
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(90)] + [rows[3], rows[3]]
    got = mined(spark.createDataFrame(rows, VECTORS), 9)
    assert got == plain_mine(rows, 9) and got


def test_hard_negatives_edges(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert mined(empty, 1) == []
    rows = vector_rows(6, 60, 3) + [(100 + i, v[:2], l) for i, v, l in vector_rows(7, 30, 3)]
    rows += [(None, [1.0, 2.0, 3.0], 1), (5, None, 1), (6, [1.0, None, 2.0], 1), (7, [1.0, float("nan"), 2.0], 0),
             (8, [float("inf"), 0.0, 0.0], 0), (9, [1.0, 1.0, 1.0], None), (50, [], 1), (51, [], 1), (52, [], 0),
             (3, [0.5, 0.5, 0.5], 2), (300, [0.0, 0.0, 0.0], 2), (301, [0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, VECTORS)
    got = mined(df, 2)
    assert got == plain_mine(rows, 2) and got
    assert mined(df.withColumn("score", F.lit("x")).withColumn("node", F.lit(1)).withColumn("cell", F.lit(2)), 2) == got
    assert mined(df.where("label = 1"), 2) == []
    huge = vector_rows(8, 30, 3) + [(900, [3e38, 1.0, 1.0], 1), (901, [1e5, 2e4, 3.0], 1), (902, [1e5, 0.0, 3.0], 2)]
    assert mined(spark.createDataFrame(huge, VECTORS), 1) == plain_mine([r for r in huge if r[0] != 900], 1)


@pytest.mark.parametrize("same", [True, False])
def test_tree_eliminates_and_equals_a_scan(same, monkeypatch):
    rows = vector_rows(9, 3000, 5, spread=0.05)
    x = np.floor(256 * np.array([r[1] for r in rows])).astype(np.int64)
    labels = np.array([r[2] for r in rows])
    radius = float((x.astype(float) ** 2).sum(axis=1).max())
    tree = gnat.build(x, labels, radius, arity=5, leaf=20)
    assert sorted(tree["order"]) == list(range(len(x)))
    asked = np.arange(0, 3000, 100)
    unit_query = np.repeat(np.arange(len(asked)), 2)
    score = x[asked][unit_query] @ x.T
    high = np.where(np.arange(len(unit_query)) % 2, np.quantile(score, 0.9, axis=1), gnat.HIGHEST).astype(np.int64)
    low = np.quantile(score, 0.2, axis=1).astype(np.int64)
    scanned = []
    scan = gnat._scan
    monkeypatch.setattr(gnat, "_scan", lambda *a: (scanned.append(len(a[-1]) * len(a[-2])), scan(*a)))
    unit, value, row = gnat.search(tree, x, labels, np.arange(len(x)), radius, x[asked], labels[asked],
                                   unit_query, low, high, same, 6)
    got = defaultdict(list)
    for u, v, r in zip(unit, value, row):
        got[u].append((-v, r))
    for u in range(len(unit_query)):
        fits = (labels == labels[asked][unit_query[u]]) == same
        want = sorted((-score[u, r], r) for r in np.flatnonzero(fits & (score[u] >= low[u]) & (score[u] <= high[u])))[:6]
        assert got[u] == want
    assert sum(scanned) < 0.5 * len(unit_query) * len(x)


# ---------------------------------------------------------------- mixing

DOCS = "doc_id long, text string, source string"


def plain_targets(sizes, weights, share, epochs):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, capped = {}, set()
    left = share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] = left * weight[s] / total
        above = [s for s in free if target[s] > epochs * sizes[s]]
        if not above:
            return target
        for s in above:
            target[s] = epochs * sizes[s]
            left -= target[s]
            capped.add(s)
        if len(capped) == len(names):
            return target


def test_mixing_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(oracles.MIXING).fetchall()
    assert sorted(tuple(r) for r in queries.op13_mixing(spark, SF).collect()) == sorted(want) and want


def mix_rows(seed, n):
    rng = random.Random(seed)
    names = ["a", "b", "ä", "hot", "hot", "hot", "hot", None, "", "tiny"]
    return [(i, " ".join(rng.choices(["w", "word", " x"], k=rng.choice([0, 1, 5, 40, 300]))),
             s if (s := rng.choice(names)) != "tiny" or i < 50 else "hot") for i in range(n)]


def test_mixing_hits_the_targets_in_words(spark):
    rows = mix_rows(1, 500) + [(9, None, "a"), (None, "x y z", "b"), (None, "x y z", "b")] + [(77, "r s t", "hot")] * 60
    df = spark.createDataFrame(rows, DOCS).withColumn("size", F.lit("clash")).withColumn("target", F.lit(0))
    got = mixing.allot(df, weights=(3, 1, 2), share=1.5).collect()
    assert len(got) == len(rows)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += count(text)
    want = plain_targets(sizes, (3, 1, 2), 1.5, 2)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert r.taken == r.copies * r.size + r.tail <= 2 * r.size and 0 <= r.tail < max(r.size, 1)
        taken[r.source] += r.taken
    assert all(abs(taken[s] - int(want[s] + 1e-9)) <= 1 for s in sizes)
    again = mixing.allot(df.repartition(7), weights=(3, 1, 2), share=1.5).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_texts_hold_what_is_taken(spark):
    df = spark.createDataFrame(mix_rows(2, 120), DOCS)
    taken = Counter({(r.doc_id): r.taken for r in mixing.allot(df, weights=(3, 1, 2), share=1.5).collect()})
    texts = {r.doc_id: r.text for r in df.collect()}
    out = Counter()
    for r in mixing.mixed(df, weights=(3, 1, 2), share=1.5).collect():
        assert texts[r.doc_id].startswith(r.text)
        out[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert +out == +taken


def test_mixing_edges(spark):
    assert mixing.allot(spark.createDataFrame([], DOCS)).collect() == []
    none = mixing.allot(spark.createDataFrame([(1, None, None), (2, "", "s"), (2, " \n", "s")], DOCS), share=1.5).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in none) == [
        (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    weights = spark.createDataFrame([("s", 1.0), (None, 1.0)], "source string, weight double")
    df = spark.createDataFrame([(1, "a b c d", "s"), (2, "a b", None), (3, "x y", "other")], DOCS)
    got = {r.doc_id: r.taken for r in mixing.allot(df, weights=weights, share=0.5).collect()}
    assert got == {1: 2, 2: 2, 3: 0}
    everything = mixing.allot(df, weights=(1,), share=5.0).collect()
    assert all(r.taken == 2 * r.size for r in everything)
