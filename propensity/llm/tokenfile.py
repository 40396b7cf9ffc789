"""Token files: corpus-wide Huffman coding of token ids.

1. Texts are tokenized where they lie and staged as raw ids.
2. Global counts of every id give one canonical, length-limited Huffman code
   (package-merge); only its code lengths are stored, they define the code.
3. Every document becomes a bit string; its checkpoints are the bit offsets of
   every ``EVERY``-th token.
4. Documents are range-partitioned and sorted by key and packed into blocks of
   about ``BLOCK_TOKENS`` tokens (whole documents), one row of the Parquet
   token file each: directory (keys, token counts), checkpoints, bit string.
   Documents start at byte bounds, so any block -- and any checkpoint in it --
   can be decoded alone with the code table.
5. Reading decodes all checkpoints of a block side by side, one table lookup
   per token.

Ids are those of the tokenizers library (no special tokens added), then the
end id.  Words recur, so the model runs once per distinct word and task and a
bounded memory of results is kept; texts that hold a special token's string, or
white space other than single inner spaces, are encoded whole.

Defined cases: NULL text is empty (the end id alone); NULL keys come first;
repeated keys stay separate rows, ordered by content; an empty table writes
and reads no block; a corpus of one distinct id gets a one-bit code.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import discard, staged

MAX_BITS = 18
EVERY = 512
BLOCK_TOKENS = 1 << 20
MEMORY_WORDS = 1 << 20
MAX_BROADCAST_PARTS = 1 << 20      # 16 MB; with more parts the join is left to Spark
# White space besides space and newline; all letters below U+0250.
_RARE_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_LETTERS, _MARKS = "[A-Za-zªµºÀ-ÖØ-öø-ɏ]+", "[.,;:!?*%$#&|]"
_LATIN = re.compile(f"( ?{_LETTERS})({_MARKS}*)(?:(\n)({_LETTERS})({_MARKS}*))?|( ?{_MARKS}+)")


# ------------------------------------------------------------------ tokenizing

class _Memory(dict):
    """Word (without its leading space) to ids; learns until it is full."""

    def __init__(self, solve):
        super().__init__()
        self.solve = solve

    def __missing__(self, word):
        ids = self.solve(" " + word)
        if len(self) < MEMORY_WORDS:
            self[word] = ids
        return ids


class Encoder:
    """Texts to ids with a bounded memory of words already seen."""

    def __init__(self, definition: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.full = Tokenizer.from_str(definition)
        self.split = self.full.pre_tokenizer.pre_tokenize_str
        self.model = self.full.model.tokenize
        self.added = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.kind = np.dtype(dtype).itemsize == 2 and "H" or "I"
        self.words = _Memory(self._word)
        self.pieces: dict[str, bytes] = {}
        # Byte-level splitting parts a word of Latin letters from marks and line ends;
        # how it spells each byte is asked of the library once.
        self.byte_level = (self.full.normalizer is None
                           and type(self.full.pre_tokenizer).__name__ == "ByteLevel")
        self.spelling = {}
        if self.byte_level:
            for code in range(128):
                self.spelling[code] = "".join(x for x, _ in self.split("x" + chr(code)))[1:]
            for code in range(0x80, 0x250):
                for value, shown in zip(chr(code).encode(), self.split(chr(code))[0][0]):
                    self.spelling[value] = shown

    @classmethod
    def of(cls, definition: str, dtype: str) -> "Encoder":
        """The worker process' own encoder: its memory outlives a task."""
        import tokenizers
        kept = vars(tokenizers).setdefault("_kept_encoders", {})
        key = (zlib.crc32(definition.encode()), len(definition), dtype)
        if key not in kept:
            kept.clear()
            kept[key] = cls(definition, dtype)
        return kept[key]

    def _ids(self, ids) -> bytes:
        packed = array(self.kind, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _piece(self, part: str, spelled: str) -> bytes:
        ids = self._ids([t.id for t in self.model(spelled)])
        if len(self.pieces) < MEMORY_WORDS:
            self.pieces[part] = ids
        return ids

    def _word(self, word: str) -> bytes:
        latin = _LATIN.fullmatch(word) if self.byte_level else None
        if latin is None:
            return b"".join(self._ids([t.id for t in self.model(piece)])
                            for piece, _ in self.split(word)) if word else b""
        out = []
        for part in latin.groups():
            if part:
                out.append(self.pieces.get(part) or self._piece(
                    part, part.encode().decode("latin-1").translate(self.spelling)))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if (not self.byte_level or "  " in text or " \n" in text or "\n " in text
                or text[0].isspace() or text[-1].isspace() or _RARE_SPACE.search(text)
                or any(token in text for token in self.added)):
            return self._ids(self.full.encode(text, add_special_tokens=False).ids)
        # A single space between non-space characters always opens a new word.
        first, *rest = text.split(" ")
        return self._word(first) + b"".join(map(self.words.__getitem__, rest))


def _tokenize(definition, dtype, end_id, size):
    """Rows (doc_id, ids, counted False); each task ends with one row of its id counts."""
    def run(batches):
        encoder = Encoder.of(definition.value, dtype)
        end = np.array([end_id], dtype).tobytes()
        total, kind = np.zeros(size, np.int64), None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            ids = [encoder.encode(t.as_py() or "") + end for t in batch.column("text")]
            for at in range(0, len(ids), 512):
                part = np.frombuffer(b"".join(ids[at:at + 512]), dtype)
                total += np.bincount(part, minlength=size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.binary()),
                 pa.array(np.zeros(len(ids), bool))], names=["doc_id", "ids", "counted"])
        if kind is not None:
            used = np.flatnonzero(total)
            pairs = np.column_stack([used, total[used]]).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None], kind), pa.array([pairs], pa.binary()), pa.array([True])],
                names=["doc_id", "ids", "counted"])
    return run


def _unpack_counts(batches):
    for batch in batches:
        for pairs in batch.column(0):
            table = np.frombuffer(pairs.as_buffer(), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, 0].copy()), pa.array(table[:, 1].copy())],
                                             names=["id", "n"])


# ------------------------------------------------------------- the Huffman code

def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal lengths of at most ``max_bits`` (package-merge); 0: id not used."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.int64)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    max_bits = max(max_bits, int(np.ceil(np.log2(len(used)))))
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(np.int64)
    merged, leaf = weight, np.ones(len(weight), bool)
    levels = [leaf]
    for _ in range(max_bits - 1):
        half = len(merged) // 2
        packages = merged[0:2 * half:2] + merged[1:2 * half:2]
        both = np.concatenate([weight, packages])
        at = np.argsort(both, kind="stable")
        merged, leaf = both[at], at < len(weight)
        levels.append(leaf)
    take, depth = 2 * len(weight) - 2, np.zeros(len(weight), np.int64)
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = depth
    return lengths


class Code:
    """Canonical code of given lengths: by length, then id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.uint8)
        self.bits = int(lengths.max()) if len(lengths) else 0
        used = np.flatnonzero(lengths)
        order = used[np.lexsort((used, lengths[used]))]
        step = np.int64(1) << (self.bits - lengths[order])
        starts = np.cumsum(step) - step              # codes, left-aligned to ``bits``
        self.left = np.zeros(len(lengths), np.uint64)    # codes, left-aligned to 64 bits
        self.left[order] = starts.astype(np.uint64) << np.uint64(64 - self.bits)
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.symbol[:int(step.sum())] = np.repeat(order, step)

    def encode(self, ids: np.ndarray, sizes: np.ndarray):
        """Bit strings of consecutive documents of ``sizes`` ids, each from a byte
        bound: (all bytes, first byte of each document, bit offset of every
        ``EVERY``-th id of a document counted from its start)."""
        length = self.lengths[ids].astype(np.int64)
        ends = np.cumsum(length)
        last = np.cumsum(sizes) - 1
        first = last + 1 - sizes
        bits = ends[last] - ends[first] + length[first]
        start = np.cumsum(-(-bits // 8)) * 8 - -(-bits // 8) * 8
        within = ends - length - np.repeat(ends[first] - length[first], sizes)
        at = within + np.repeat(start, sizes)
        word, shift = at >> 6, (at & 63).astype(np.uint64)
        code = self.left[ids]
        heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        packed = np.zeros(int(word[-1]) + 2, np.uint64)
        packed[word[heads]] = np.add.reduceat(code >> shift, heads)   # disjoint bits: sum is union
        over = np.flatnonzero((at & 63) + length > 64)
        packed[word[over] + 1] |= code[over] << (np.uint64(64) - shift[over])
        total = int(start[-1] + bits[-1] + 7) // 8
        marks = within[(np.arange(len(ids)) - np.repeat(first, sizes)) % EVERY == 0]
        return packed.astype(">u8").tobytes()[:total], start // 8, marks

    def decode(self, payload: bytes, marks: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """Ids from each bit offset on: ``counts`` of them, all lanes together."""
        raw = np.frombuffer(payload + b"\0" * 8, np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        out = np.zeros((EVERY, len(marks)), np.uint32)
        order = np.argsort(-counts, kind="stable")
        at, left = marks[order].copy(), counts[order]
        shift = 32 - self.bits
        live = len(at)
        for step in range(int(left[0]) if live else 0):
            live = int(np.searchsorted(-left, -step, side="left"))   # lanes longer than step
            here = at[:live]
            code = (window[here >> 3] << (here & 7).astype(np.uint32)) >> np.uint32(shift)
            found = self.symbol[code]
            out[step, :live] = found
            at[:live] += self.lengths[found]
        lanes = out.T
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return [lanes[back[i], :counts[i]] for i in range(len(order))]


def _encode(code, dtype):
    def run(batches):
        own = Code(code.value)
        for batch in batches:
            column = batch.column("ids")
            sizes = np.array([len(x.as_buffer()) for x in column], np.int64) // np.dtype(dtype).itemsize
            groups = np.cumsum(sizes) // BLOCK_TOKENS          # bounded expansion
            bits, marks = [], []
            for at in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(groups)) + 1):
                if not len(at):
                    continue
                some = sizes[at]
                ids = np.frombuffer(b"".join(column[i].as_buffer() for i in at.tolist()), dtype)
                payload, start, offsets = own.encode(ids, some)
                stop = np.append(start[1:], len(payload)).tolist()
                bits += [payload[a:b] for a, b in zip(start.tolist(), stop)]
                lanes = np.cumsum(-(-some // EVERY))
                marks += [x.astype("<u4").tobytes() for x in np.split(offsets, lanes[:-1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), pa.array(bits, pa.binary()),
                 pa.array(marks, pa.binary())], names=["doc_id", "n", "bits", "marks"])
    return run


def _pack(kind):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        state = {"block": 0, "before": 0}
        keys, sizes, payload, marks, at, tokens = [], [], [], [], 0, 0

        def block():
            row = pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "block": pa.array([state["block"]], pa.int64()),
                "before": pa.array([state["before"]], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()),
                "doc_ids": pa.array([keys], pa.list_(kind)),
                "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "marks": pa.array([np.concatenate(marks).astype("<i8").tobytes()], pa.binary()),
                "payload": pa.array([b"".join(payload)], pa.binary())})
            state["block"] += 1
            state["before"] += tokens
            return row

        for batch in batches:
            for key, n, bits, offsets in zip(*(batch.column(c).to_pylist()
                                               for c in ("doc_id", "n", "bits", "marks"))):
                keys.append(key)
                sizes.append(n)
                marks.append(np.frombuffer(offsets, "<u4").astype(np.int64) + 8 * at)
                payload.append(bits)
                at += len(bits)
                tokens += n
                if tokens >= BLOCK_TOKENS:
                    yield block()
                    keys, sizes, payload, marks, at, tokens = [], [], [], [], 0, 0
        if keys:
            yield block()
    return run


_BLOCK = ("part int, block long, before long, tokens long, doc_ids array<{kind}>, "
          "sizes array<long>, marks binary, payload binary")


def write_token_files(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = 0,
                      key: str = "doc_id", text: str = "text") -> None:
    """Write ``path``/code (id, length) and ``path``/blocks."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    size = max(Tokenizer.from_file(tokenizer_file).get_vocab_size(), end_id + 1)
    dtype = "<u2" if size <= 1 << 16 else "<u4"
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = spark.sparkContext.broadcast(file.read())   # a few MB, corpus-independent
    rows = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    field = rows.schema["doc_id"]
    kind = field.dataType.simpleString()
    found, ids_path = staged(rows.mapInArrow(_tokenize(definition, dtype, end_id, size),
                                             f"doc_id {kind}, ids binary, counted boolean"),
                             "token-ids")
    ids = found.where("not counted").drop("counted")
    counted = (found.where("counted").select("ids").mapInArrow(_unpack_counts, "id long, n long")
               .groupBy("id").agg(F.sum("n").alias("n")).toPandas())   # one row per id
    counts = np.zeros(size, np.int64)
    counts[counted["id"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    lengths = code_lengths(counts)
    (spark.createDataFrame([(i, int(x)) for i, x in enumerate(lengths) if x], "id long, length int")
     .coalesce(1).write.parquet(f"{path}/code"))
    shared = spark.sparkContext.broadcast(lengths)
    coded, coded_path = staged(ids.mapInArrow(
        _encode(shared, dtype), f"doc_id {kind}, n long, bits binary, marks binary")
        .withColumn("tie", F.xxhash64("bits")), "token-bits")
    discard(spark, ids_path)
    from pyspark.sql.pandas.types import to_arrow_type
    (coded.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .mapInArrow(_pack(to_arrow_type(field.dataType)), _BLOCK.format(kind=kind))
     .write.option("compression", "uncompressed").parquet(f"{path}/blocks"))
    discard(spark, coded_path)


def _decode(code):
    def run(batches):
        own = Code(code.value)
        for batch in batches:
            starts = batch.column("start").to_pylist()
            for i, start in enumerate(starts):
                sizes = np.array(batch.column("sizes")[i].as_py(), np.int64)
                marks = np.frombuffer(batch.column("marks")[i].as_py(), "<i8")
                lanes = -(-sizes // EVERY)
                counts = np.full(len(marks), EVERY, np.int64)
                counts[np.cumsum(lanes) - 1] = sizes - (lanes - 1) * EVERY
                parts = own.decode(batch.column("payload")[i].as_py(), marks, counts)
                ids, lane = [], 0
                for n in lanes.tolist():
                    ids.append(np.concatenate(parts[lane:lane + n]).astype("<u4"))
                    lane += n
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[i].values,
                     pa.array(start + np.cumsum(sizes) - sizes, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])
    return run


def _digest(decoded):
    def run(batches):
        for batch in decoded(batches):
            crc = [zlib.crc32(x.as_buffer()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def read_token_files(spark, path: str, digest: bool = False) -> DataFrame:
    """Decode token files: doc_id, start (tokens of all earlier documents),
    n_tokens and ids (little-endian unsigned 32-bit), or their crc32."""
    code = spark.read.parquet(f"{path}/code").toPandas()          # one row per used id
    lengths = np.zeros(int(code["id"].max()) + 1 if len(code) else 1, np.int64)
    lengths[code["id"].to_numpy(np.int64)] = code["length"].to_numpy(np.int64)
    blocks = spark.read.parquet(f"{path}/blocks")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (blocks.groupBy("part").agg(F.sum("tokens").alias("tokens"))   # one row per part
               .select("part", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")))
    small = offsets.count() <= MAX_BROADCAST_PARTS
    placed = blocks.join(F.broadcast(offsets) if small else offsets, "part").select(
        (F.col("base") + F.col("before")).alias("start"), "doc_ids", "sizes", "marks", "payload")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    decoded = _decode(spark.sparkContext.broadcast(lengths))
    if digest:
        return placed.mapInArrow(_digest(decoded),
                                 f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
    return placed.mapInArrow(decoded, f"doc_id {kind}, start long, n_tokens long, ids binary")
