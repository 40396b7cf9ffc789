"""SentencePiece encoding as a relational lattice, and decoding.

Piece table: every ordinary piece of the model file with its id and score; a
character that is no piece falls back to the model's byte pieces.  A text is
prefixed with one space and cut into *segments* that no piece crosses: between any
two neighbouring characters that stand side by side inside no piece.  So the best path of a text is the best paths of its
segments in a row, and each frequent segment of the corpus is solved once:

1. distinct segments with their frequencies (combined per task, the ``KEPT`` most frequent pass);
2. explode the substrings of those lengths that some piece with the same first two
   characters has, equi-join them to the piece table: the edges of the lattice;
3. group the edges by segment, and fold them in order of their end with the
   higher-order function ``aggregate``: best score per position (ties: the
   longer last piece, then the larger id), then back along the best path.
   Edges are folded in slices, so very long segments cost in proportion.

Only *usable* pieces make edges: a piece whose own text has a better path of other
pieces is on no best path, as that path could take its place.

Back to the texts: tasks pass on only the segments they meet most often, so the table
of solved segments is bounded by the number of tasks, not by the corpus' rare words.  The most
frequent ones, up to ``HEAD`` of them and ``HEAD_BYTES`` in all (counted before they
are collected; none of more than ``HEAD_IDS`` ids), are broadcast as sorted hash, offset and
id arrays; tasks cut, hash and look up whole blocks of texts as arrays.  A segment that is not
there has its best path found where it lies, by the same lattice and ties (``_Solver``).
Segments that share a hash stay out of the head; one that only shares the hash of a head
segment shows when the ids are decoded, and its text is solved without the head.

The path maximises the sum of the table's scores; for a table made by merges
this is not the merge order.  Decoding concatenates the pieces' bytes and drops
the first space: it restores every text exactly, the character U+2581 included.

Defined cases: NULL and empty texts have no ids (decoded: empty text);
repeated rows are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm.common import bounded_broadcast, staged

HEAD, HEAD_BYTES, HEAD_IDS = 1 << 21, 64 << 20, 64     # rows, bytes as collected, ids of a segment
PARTITION_BYTES = 16 << 20
_HASH_GROUPS = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
COMBINED, KEPT = 1 << 17, 1 << 16       # segments that a task holds while it combines, and passes on
LONGEST = 2048                  # characters of a segment that a task passes on
SOLVED = 1 << 16                # rare segments whose ids a task keeps
_COUNT_CHARS = _ENCODE_CHARS = 1 << 17                 # characters of a block of whole texts
_CELLS = 1 << 26                # of the table of neighbours; larger ones are searched
_ROOT = 0x9E3779B97F4A7C15      # odd, so it has an inverse modulo 2^64
_SLICE = 256
_UNKNOWN_PENALTY = 10.0
_RARE_SCORE = -1e8        # pieces below are never preferred to a byte path's cost basis


class PieceTable:
    """What the model file says: strings, scores, byte pieces."""

    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.rows, self.byte_ids = [], [None] * 256
        self.raw = [b""] * model.vocab_size()
        for i in range(model.vocab_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(text[3:5], 16)
                self.byte_ids[value] = i
                self.raw[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                text = text.replace("▁", " ")
                self.rows.append((text, i, float(model.get_score(i))))
                self.raw[i] = text.encode()
        if None in self.byte_ids:
            raise ValueError("the model has no byte pieces: texts could not be restored")
        self.longest = max(len(text) for text, _, _ in self.rows)
        self.unknown = min(s for _, _, s in self.rows if s > _RARE_SCORE) - _UNKNOWN_PENALTY
        known = {text: score for text, _, score in self.rows}
        self.usable = [row for row in self.rows if self._usable(row[0], row[2], known)]
        self.pairs = frozenset(text[i:i + 2] for text, _, _ in self.rows for i in range(len(text) - 1))

    def _usable(self, piece: str, score: float, known: dict) -> bool:
        """Whether no path of other pieces over the piece's text is better (beyond rounding)."""
        if len(piece) == 1:
            return True
        best = [0.0]
        for e in range(1, len(piece) + 1):
            best.append(max(best[e - k] + known.get(piece[e - k:e], self.unknown) for k in range(1, e + 1)
                            if k < len(piece) and (k == 1 or piece[e - k:e] in known)))
        return best[-1] <= score + 1e-6 * max(1.0, abs(score))

    def lens(self) -> dict:
        """By two characters: the lengths over 1 of the pieces that start with them."""
        found = {}
        for text, _, _ in self.usable:
            if len(text) > 1:
                found.setdefault(text[:2], set()).add(len(text))
        return {h: sorted(v) for h, v in found.items()}

    def lengths(self, spark: SparkSession) -> DataFrame:
        """(head, lens) of ``lens``."""
        return spark.createDataFrame(list(self.lens().items()), "head string, lens array<int>")

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.usable, "sub string, id int, score double")


class _Cutter:
    """Segments of a block of texts as arrays, each with a polynomial hash of its characters."""

    def __init__(self, pairs):
        self.side = []
        for i in (0, 1):
            chars = sorted({pair[i] for pair in pairs})
            code = np.zeros(0x110000, np.uint32)              # 0: a character of no pair
            code[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
            self.side.append(code)
        self.width = int(self.side[1].max()) + 1
        codes = np.array(sorted(int(self.side[0][ord(p[0])]) * self.width + int(self.side[1][ord(p[1])])
                                for p in pairs), np.int64)
        cells = (int(self.side[0].max()) + 1) * self.width
        self.codes, self.joined = codes, None
        if cells <= _CELLS:
            self.joined = np.zeros(cells, bool)
            self.joined[codes] = True
        self.power = self.inverse = np.empty(0, np.uint64)

    def _powers(self, n: int):
        if len(self.power) < n:
            for name, base in (("power", _ROOT), ("inverse", pow(_ROOT, -1, 1 << 64))):
                setattr(self, name, np.cumprod(np.full(n, base, np.uint64)))

    def __call__(self, texts: list[str]):
        """(whole, points, first, b, e, h): the joined texts and their code points, where each
        text starts (at its space), and the segments' starts, ends and hashes."""
        whole = " " + " ".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        code = self.side[0][points[:-1]].astype(np.int64) * self.width + self.side[1][points[1:]]
        starts = np.ones(len(points), bool)
        starts[1:] = ~(np.isin(code, self.codes) if self.joined is None else self.joined[code])
        starts[first] = True
        b = np.flatnonzero(starts)
        e = np.append(b[1:], len(points))
        return whole, points, first, b, e, self._hashes(points, b, e)

    def _hashes(self, points, b, e):
        self._powers(len(points))
        total = np.cumsum((points.astype(np.uint64) + np.uint64(1)) * self.power[:len(points)])
        h = total[e - 1]
        h[1:] -= total[b[1:] - 1]
        h[1:] *= self.inverse[b[1:] - 1]
        return h

    def hashes(self, segments: list[str]):
        """The hashes of segments that stand alone."""
        e = np.cumsum([len(s) for s in segments])
        points = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32)
        return self._hashes(points, np.append(0, e[:-1]), e)


def _blocks(texts: list, chars: int):
    """Positions of the non-empty texts, in runs of about ``chars`` characters."""
    run, size = [], 0
    for i, text in enumerate(texts):
        if text:
            run.append(i)
            size += len(text)
            if size >= chars:
                yield run
                run, size = [], 0
    if run:
        yield run


def _distinct(points, b, e, h):
    """(place of one of its occurrences, number of occurrences) of every distinct segment; None
    if two different ones share a hash."""
    _, at, back, n = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    size, twin = e - b, at[back]
    if (size != size[twin]).any():
        return None
    there = np.arange(len(points)) + np.repeat(b[twin] - b, size)
    return None if (points[there] != points).any() else (at, n)


def _segments(pairs):
    def run(batches):
        cutter, seen = _Cutter(pairs), Counter()
        for batch in (b.slice(at, 4096) for b in batches for at in range(0, b.num_rows, 4096)):
            texts = batch.column(0).to_pylist()
            for block in _blocks(texts, _COUNT_CHARS):
                whole, points, _, b, e, h = cutter([texts[i] for i in block])
                at, n = _distinct(points, b, e, h) or (np.arange(len(b)), np.ones(len(b), np.int64))
                short = e[at] - b[at] <= LONGEST
                at, n = at[short], n[short]
                for start, end, times in zip(b[at].tolist(), e[at].tolist(), n.tolist()):
                    seen[whole[start:end]] += times
                if len(seen) > COMBINED:
                    seen = Counter(dict(seen.most_common(KEPT)))
        kept = dict(seen.most_common(KEPT))
        if kept:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(kept), pa.string()), pa.array(list(kept.values()), pa.int64()),
                 pa.array(cutter.hashes(list(kept)).view(np.int64))], names=["seg", "n", "hash"])
    return run


# --------------------------------------------------------------- lattice and fold

def edges(segments: DataFrame, pieces: DataFrame, table: PieceTable) -> DataFrame:
    """``segments(seg, n, hash)`` -> (seg, n, hash, e, len, score, id), one row per lattice
    edge: the piece of ``len`` characters ending at ``e`` (id -1: byte pieces)."""
    starts = (segments.select("seg", "n", "hash", F.explode(F.sequence(F.lit(1), F.length("seg"))).alias("b"))
              .withColumn("head", F.expr("substring(seg, b, 2)"))
              .join(F.broadcast(table.lengths(segments.sparkSession)), "head", "left"))
    room = F.length("seg") - F.col("b") + 1
    longer = F.coalesce(F.filter("lens", lambda k: k <= room), F.array().cast("array<int>"))
    spans = (starts.select("seg", "n", "hash", "b", F.explode(F.concat(F.array(F.lit(1)), longer)).alias("len"))
             .select("seg", "n", "hash", (F.col("b") + F.col("len") - 1).alias("e"), "len",
                     F.expr("substring(seg, b, len)").alias("sub")))
    return (spans.join(F.broadcast(pieces), "sub", "left")       # the vocabulary: bounded
            .where("id is not null or len = 1")
            .select("seg", "n", "hash", "e", "len", F.coalesce("score", F.lit(table.unknown)).alias("score"),
                    F.coalesce("id", F.lit(-1)).alias("id")))


def best_path(found: str, longest: int) -> Column:
    """Fold of the edge array ``found``, sorted by (e, len), to one long per
    position: the best last piece there, as length << 32 | id + 1."""
    pick = "shiftleft(cast(x.len as bigint), 32) + x.id + 1"
    same = "s.acc[size(s.acc) - x.len] + x.score"
    following = "if(x.len = 1, s.cur, s.acc[size(s.acc) + 1 - x.len]) + x.score"
    # acc: scores of the positions before e; cur, pick: best so far at position e.
    step = (f"if(x.e = s.e, if({same} >= s.cur, named_struct('acc', s.acc, 'back', s.back, "
            f"'cur', {same}, 'pick', {pick}, 'e', s.e), s), "
            f"named_struct('acc', concat(s.acc, array(s.cur)), 'back', concat(s.back, array(s.pick)), "
            f"'cur', {following}, 'pick', {pick}, 'e', x.e))")
    slices = f"sequence(0, (size({found}) - 1) div {_SLICE})"
    start = ("named_struct('acc', cast(array() as array<double>), 'cur', 0D, 'pick', 0L, 'e', 0, "
             "'done', cast(array() as array<array<bigint>>))")
    return F.expr(f"""aggregate({slices}, {start},
        (o, c) -> aggregate(slice({found}, c * {_SLICE} + 1, {_SLICE}),
            named_struct('acc', o.acc, 'back', cast(array() as array<bigint>),
                         'cur', o.cur, 'pick', o.pick, 'e', o.e),
            (s, x) -> {step},
            s -> named_struct('acc', slice(s.acc, greatest(size(s.acc) - {longest}, 0) + 1, {longest}),
                              'cur', s.cur, 'pick', s.pick, 'e', s.e,
                              'done', concat(o.done, array(s.back)))),
        o -> slice(concat(flatten(o.done), array(o.pick)), 2, o.e))""")


def walk_back(states: str) -> Column:
    """The pieces (id, e) of the best path, first to last, from all positions."""
    slices = f"sequence(0, (size({states}) - 1) div {_SLICE})"
    taken = "cast(array() as array<struct<id:int,e:int>>)"
    piece = "named_struct('id', cast(x & 4294967295L as int) - 1, 'e', s.e)"
    return F.expr(f"""reverse(aggregate({slices},
        named_struct('skip', 0, 'e', size({states}),
                     'done', cast(array() as array<array<struct<id:int,e:int>>>)),
        (o, c) -> aggregate(slice(reverse({states}), c * {_SLICE} + 1, {_SLICE}),
            named_struct('skip', o.skip, 'e', o.e, 'out', {taken}),
            (s, x) -> if(s.skip > 0, named_struct('skip', s.skip - 1, 'e', s.e - 1, 'out', s.out),
                         named_struct('skip', cast(shiftright(x, 32) as int) - 1, 'e', s.e - 1,
                                      'out', concat(s.out, array({piece})))),
            s -> named_struct('skip', s.skip, 'e', s.e, 'done', concat(o.done, array(s.out)))),
        o -> flatten(o.done)))""")


def path_ids(path: str, segment: str, byte_ids: list[int]) -> Column:
    table = "array(" + ", ".join(map(str, byte_ids)) + ")"
    raw = f"encode(substring({segment}, p.e, 1), 'utf-8')"
    spelled = (f"transform(sequence(1, octet_length({raw})), b -> element_at({table}, "
               f"cast(conv(substring(hex({raw}), 2 * b - 1, 2), 16, 10) as int) + 1))")
    return F.expr(f"flatten(transform({path}, p -> if(p.id >= 0, array(p.id), {spelled})))")


def segment_table(docs: DataFrame, table: PieceTable, text: str = "text") -> DataFrame:
    """(seg, n, hash, ids) of the segments that tasks met most often (all, if a task met at
    most ``KEPT``; ``n``: as passed on), staged.

    One shuffle: the segments, combined per task, are dealt by value to
    partitions sized by the corpus' bytes; counting, lattice, grouping and
    fold all happen where a segment lies."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    counted = (docs.select(F.col(f"`{text}`").alias("text"))
               .mapInArrow(_segments(table.pairs), "seg string, n long, hash long")
               .repartition(max(1, -(-size // PARTITION_BYTES)), "seg")
               .groupBy("seg").agg(F.sum("n").alias("n"), F.max("hash").alias("hash")))
    solved = (edges(counted, table.frame(spark), table)
              .groupBy("seg").agg(F.max("n").alias("n"), F.max("hash").alias("hash"),
                                  F.sort_array(F.collect_list(
                                      F.struct("e", "len", "score", "id"))).alias("found"))
              .select("seg", "n", "hash", best_path("found", table.longest).alias("states"))
              .select("seg", "n", "hash", walk_back("states").alias("path"))
              .select("seg", "n", "hash", path_ids("path", "seg", table.byte_ids).alias("ids")))
    # Groups of a partition gathered by hashing; beyond this number Spark sorts, and may spill.
    before = spark.conf.get(_HASH_GROUPS, None)
    spark.conf.set(_HASH_GROUPS, str(1 << 15))
    try:
        done, _ = staged(solved, "segment-ids")
    finally:
        spark.conf.unset(_HASH_GROUPS) if before is None else spark.conf.set(_HASH_GROUPS, before)
    return done


# ----------------------------------------------------------------- texts to ids

class _Lookup:
    """The head's arrays (sorted hashes, offsets, ids), found by the leading bits of a hash."""

    def __init__(self, hashes, offsets, ids):
        self.hashes, self.offsets, self.ids = hashes, offsets.astype(np.int64), ids
        bits = min(22, max(1, len(hashes).bit_length()))
        self.shift = np.uint64(64 - bits)
        sizes = np.bincount((hashes >> self.shift).astype(np.int64), minlength=1 << bits)
        self.start = np.concatenate([[0], np.cumsum(sizes)])

    def places(self, wanted):
        """Index of each hash in the head, -1 where it is not there."""
        top = (wanted >> self.shift).astype(np.int64)
        at, stop = self.start[top], self.start[top + 1]
        found = np.full(len(wanted), -1, np.int64)
        live = np.flatnonzero(at < stop)
        while len(live):
            hit = self.hashes[at[live]] == wanted[live]
            found[live[hit]] = at[live[hit]]
            live = live[~hit]
            at[live] += 1
            live = live[at[live] < stop[live]]
        return found

    def spans(self, raw: list[bytes]):
        """Characters of each segment of the head."""
        starts = np.array([sum((x & 0xC0) != 0x80 for x in piece) for piece in raw], np.int64)
        total = np.concatenate([[0], np.cumsum(starts[self.ids])])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]


class _Solver:
    """The lattice of single segments: edges by the rule of ``edges``, ties as ``best_path``."""

    def __init__(self, usable, lens, unknown, byte_ids):
        self.known = {text: (score, i) for text, i, score in usable}
        self.lens, self.unknown, self.byte_ids = lens, unknown, byte_ids
        self.ids = lru_cache(SOLVED)(self._ids)

    def __call__(self, segment: str):
        return self.ids(segment) if len(segment) <= LONGEST else self._ids(segment)

    def _ids(self, segment: str):
        size, known, lens, unknown = len(segment), self.known.get, self.lens.get, (self.unknown, -1)
        best, last = [0.0] + [None] * size, [None] * (size + 1)
        for b in range(size):
            score, i = known(segment[b], unknown)
            # The first path that reaches a place has the longest last piece: it stays in ties.
            if best[b + 1] is None or best[b] + score > best[b + 1]:
                best[b + 1], last[b + 1] = best[b] + score, (b, i)
            for k in lens(segment[b:b + 2], ()):
                e = b + k
                found = known(segment[b:e]) if e <= size else None
                if found and (best[e] is None or best[b] + found[0] > best[e]):
                    best[e], last[e] = best[b] + found[0], (b, found[1])
        out, e = [], size
        while e:
            b, i = last[e]
            out += [i] if i >= 0 else [self.byte_ids[x] for x in reversed(segment[b:e].encode())]
            e = b
        return np.array(out[::-1], np.int32)


class _Encoder:
    """Ids of blocks of texts: the head's segments by lookup, the others solved here."""

    def __init__(self, head, pairs, raw, solver):
        self.lookup, self.cutter, self.raw, self.solve = _Lookup(*head), _Cutter(pairs), raw, solver
        self.chars = self.lookup.spans(raw)

    def __call__(self, texts: list[str], use_head: bool = True):
        """Per text: its ids, and whether they decode to it."""
        whole, _, first, b, e, h = self.cutter(texts)
        at = self.lookup.places(h) if use_head else np.full(len(b), -1)
        known = at >= 0
        known[known] = self.chars[at[known]] == (e - b)[known]
        own = [self.solve(whole[i:j]) for i, j in zip(b[~known].tolist(), e[~known].tolist())]
        offsets, size = self.lookup.offsets, np.empty(len(b), np.int64)
        size[known] = offsets[at[known] + 1] - offsets[at[known]]
        size[~known] = [len(v) for v in own]
        before = np.concatenate([[0], np.cumsum(size)])
        ids, looked = np.empty(before[-1], np.int32), np.repeat(known, size)
        shift = offsets[at[known]] - np.cumsum(size[known]) + size[known]
        ids[looked] = self.lookup.ids[np.arange(len(ids) - sum(map(len, own))) + np.repeat(shift, size[known])]
        ids[~looked] = np.concatenate([*own, ids[:0]])
        edge = before[np.append(np.searchsorted(b, first), len(b))]
        out = [ids[low:high] for low, high in zip(edge[:-1], edge[1:])]
        # Segments of the right lengths that join to the block are its segments, one by one.
        if b"".join(map(self.raw.__getitem__, ids.tolist())) == whole.encode("utf-8", "surrogatepass"):
            return [(v, True) for v in out]
        same = [_decoded(v, self.raw) == " " + t for v, t in zip(out, texts)]
        return [(v, True) if ok else self([t], False)[0] if use_head else (v, False)
                for v, ok, t in zip(out, same, texts)]


def _lists(values: list) -> pa.Array:
    """list<int32> of numpy arrays."""
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*values, np.empty(0, np.int32)])))


def _with_text(texts, ids, same):
    return [pa.array(texts, pa.string()), _lists(ids)]


def _with_digest(keep_ids):
    """n_pieces, ids_crc32, round_trip[, ids]."""
    def columns(texts, ids, same):
        crc = [zlib.crc32(v.astype("<u4").tobytes()) for v in ids]
        return [pa.array([len(v) for v in ids], pa.int64()), pa.array(crc, pa.int64()),
                pa.array(same, pa.bool_()), *([_lists(ids)] if keep_ids else [])]
    return columns


def _decoded(ids: np.ndarray, raw: list[bytes]) -> str:
    return b"".join(map(raw.__getitem__, ids.tolist())).decode("utf-8", "replace")


def _encode_batches(head, pieces, pairs, columns, names):
    """Rows with what ``columns`` makes of their ids."""
    def run(batches):
        raw, *rule = pieces.value
        encoder = _Encoder(head.value, pairs, raw, _Solver(*rule))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):      # bounded output arrays
                part = batch.slice(at, 1024)
                texts = part.column("text").to_pylist()
                ids, same = [np.empty(0, np.int32) for _ in texts], [True] * len(texts)
                for block in _blocks(texts, _ENCODE_CHARS):
                    for i, found in zip(block, encoder([texts[i] for i in block])):
                        ids[i], same[i] = found
                yield pa.RecordBatch.from_arrays([part.column("key"), *columns(texts, ids, same)],
                                                 names=["key", *names])
    return run


def _head(segments: DataFrame, vocabulary: int):
    """Arrays of the most frequent segments: at most ``HEAD`` and ``HEAD_BYTES``; the
    frequency class that does not fit whole is taken by parts (1/64 by hash)."""
    shared, _ = staged(segments.groupBy("hash").agg(F.count("*").alias("k")).where("k > 1")
                       .select("hash"), "shared-hashes")
    clashes = shared.count()
    if clashes:                                             # a shared hash is never looked up
        segments = segments.join(bounded_broadcast(shared, clashes), "hash", "left_anti")
    classed = (segments.where(F.size("ids") <= HEAD_IDS)
               .withColumn("rank", F.floor(8 * F.log2("n")).cast("int") * 64
                           + F.pmod(F.xxhash64("seg"), F.lit(64)).cast("int")))
    # A row as collected: hash, offset and 32-bit ids.
    sizes = (classed.groupBy("rank").agg(F.count("*").alias("rows"),
                                         F.sum(12 + 4 * F.size("ids")).alias("bytes"))
             .orderBy(F.desc("rank")).collect())                        # under 2^15 rows
    total, space, lowest = 0, 0, None
    for row in sizes:
        total, space = total + row["rows"], space + row["bytes"]
        if total > HEAD or space > HEAD_BYTES:
            break
        lowest = row["rank"]
    rows = (classed.where(F.lit(lowest is not None) & (F.col("rank") >= F.lit(lowest)))
            .select("hash", "ids").toArrow())
    hashes = rows.column("hash").to_numpy().view(np.uint64)
    lists = rows.column("ids").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], pa.list_(pa.int32()))
    order = np.argsort(hashes)
    hashes = hashes[order]
    lists = lists.take(pa.array(order))
    offsets = lists.offsets.to_numpy()
    values = lists.flatten().to_numpy()
    small = vocabulary <= 1 << 16
    return (hashes, (offsets - offsets[0]).astype(np.uint32) if len(offsets) else np.zeros(1, np.uint32),
            values.astype(np.uint16 if small else np.int32))


def _solve(docs, model_file, key, text, columns, fields) -> DataFrame:
    broadcast = docs.sparkSession.sparkContext.broadcast
    table = PieceTable(model_file)
    pieces = broadcast((table.raw, table.usable, table.lens(), table.unknown, table.byte_ids))
    head = broadcast(_head(segment_table(docs, table, text), len(table.raw)))
    rows = docs.select(key.alias("key"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        _encode_batches(head, pieces, table.pairs, columns, [f.split()[0] for f in fields]),
        f"key {kind}, {', '.join(fields)}")


def encode(docs: DataFrame, model_file: str, key: Column, text: str = "text") -> DataFrame:
    """(key, text, ids): one row per input row."""
    return _solve(docs, model_file, key, text, _with_text, ["text string", "ids array<int>"])


def encode_digest(docs: DataFrame, model_file: str, key: Column, text: str = "text",
                  keep_ids: bool = False) -> DataFrame:
    """(key, n_pieces, ids_crc32, round_trip[, ids]): crc32 over the little-endian
    32-bit ids, and whether decoding them restores the text."""
    return _solve(docs, model_file, key, text, _with_digest(keep_ids),
                  ["n_pieces long", "ids_crc32 long", "round_trip boolean",
                   *(["ids array<int>"] if keep_ids else [])])


def decode_ids(ids: np.ndarray, raw: list[bytes]) -> str:
    return _decoded(ids, raw)[1:]


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(key, decoded) of ``encoded(key, ids)``."""
    raw = encoded.sparkSession.sparkContext.broadcast(PieceTable(model_file).raw)
    kind = encoded.schema["key"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = [decode_ids(ids.values.to_numpy(), raw.value) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(texts, pa.string())],
                                             names=["key", "decoded"])
    return encoded.select("key", "ids").mapInArrow(run, f"key {kind}, decoded string")
