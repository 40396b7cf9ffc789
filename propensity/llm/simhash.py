"""SimHash near-duplicates: binary-trie self-join over distinct fingerprints.

Fingerprint: words are maximal runs outside space and \\t..\\r of the text with
A-Z lower-cased; every run of ``shingle`` words, repeats included, joined by
one space, is hashed with XXH64 (UTF-8, seed 42); a bit is set if it is set in
more than half the hashes.  Fewer words: the whole sequence is one shingle; no
word (NULL, empty, blank): fingerprint zero, which links like any other.

Join: distinct fingerprints are leaves of a binary trie.  Two fingerprints at
most ``max_bits`` apart differ in at most ``max_bits // 2`` bits in one of
their halves, so the trie is walked twice, once with either half first, with
that smaller error budget inside the leading half and the whole budget after
it.  The walk goes over *pairs* of nodes, adds up the bits in which they differ
and drops a pair as soon as the budget is exceeded:

* the upper levels are walked by Spark on node counts alone (prefix pairs);
  pairs holding too many leaves go down ``STEP`` more bits, however crowded
  one prefix is, until every remaining pair is a bounded task;
* below, one task walks each pair of sub-tries with numpy, level by level,
  skipping pairs whose leaves are already in one component, and returns
  spanning links only (never all pairs of a crowded group).

Links are merged into components by Spark joins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import bounded_broadcast, row_fingerprint, staged
from propensity.llm.components import connected_components

SEED = 42
HALF = 32
STEP = 4
NODE_LEAVES = 1 << 15     # mean leaves under a node where Spark's walk starts
TASK_LEAVES = 1 << 17     # a node pair with more leaves is split further
_FRONTIER = 1 << 18
_DIRECT = 16


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one text (unsigned)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = len(words) - size + 1
    hashed = xxhash.xxh64_intdigest
    values = np.fromiter(
        (hashed(flat[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[size - 1:].tolist())),
        np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 4096):      # bounded unpacking for very long texts
        block = values[at:at + 4096]
        bits = np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(shingle):
    def run(batches):
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in texts),
                                 np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(prints.view(np.int64), pa.int64())], names=["key", "fp"])
    return run


def fingerprints(docs: DataFrame, key, text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fp): one row per input row; ``key`` is any column expression."""
    source = docs.select(key.alias("key"), F.col(f"`{text}`").alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(_fingerprint_batches(shingle), f"key {kind}, fp long")


# ------------------------------------------------------- sub-trie pair walking

def _root(parent, i):
    while True:
        up = parent[i]
        again = parent[up]
        if np.array_equal(up, again):
            return up
        i = again


def _unite(parent, a, b):
    while len(a):
        a, b = _root(parent, a), _root(parent, b)
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _expand(la, ra, lb, rb):
    """All index pairs of the given range pairs."""
    wide = rb - lb
    sizes = (ra - la) * wide
    which = np.repeat(np.arange(len(la)), sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return la[which] + within // wide[which], lb[which] + within % wide[which]


def trie_links(keys: np.ndarray, depth: int, max_bits: int) -> np.ndarray:
    """Walk the pairs of trie nodes at ``depth`` that hold the sorted distinct
    ``keys`` (unsigned, leading half first); returns each key's component root
    index under links of at most ``max_bits`` that the budget admits."""
    n = len(keys)
    parent = np.arange(n)
    if n < 2:
        return parent
    near = np.bitwise_count(keys[1:] ^ keys[:-1]) <= max_bits
    at = np.flatnonzero(near)
    _unite(parent, at, at + 1)
    top = keys >> np.uint64(64 - depth) if depth else np.zeros(n, np.uint64)
    edges = np.concatenate([[0], np.flatnonzero(top[1:] != top[:-1]) + 1, [n]])
    lo, hi = edges[:-1], edges[1:]
    i, j = np.triu_indices(len(lo))
    err = np.bitwise_count(top[lo[i]] ^ top[lo[j]]).astype(np.int64)
    stack = [(depth, lo[i], hi[i], lo[j], hi[j], err)]
    while stack:
        d, la, ra, lb, rb, err = stack.pop()
        budget = max_bits // 2 if d <= HALF else max_bits
        label = _root(parent, np.arange(n))
        run = np.concatenate([[0], np.cumsum(label[1:] != label[:-1])])
        joined = ((run[la] == run[ra - 1]) & (run[lb] == run[rb - 1]) & (label[la] == label[lb]))
        keep = (err <= budget) & ~joined
        la, ra, lb, rb, err = (x[keep] for x in (la, ra, lb, rb, err))
        if not len(la):
            continue
        if len(la) > _FRONTIER:
            cut = len(la) // 2
            stack.append((d, la[cut:], ra[cut:], lb[cut:], rb[cut:], err[cut:]))
            stack.append((d, la[:cut], ra[:cut], lb[:cut], rb[:cut], err[:cut]))
            continue
        small = ((ra - la) * (rb - lb) <= _DIRECT) | (d >= 64)
        if small.any():
            x, y = _expand(la[small], ra[small], lb[small], rb[small])
            linked = (x != y) & (np.bitwise_count(keys[x] ^ keys[y]) <= max_bits)
            _unite(parent, x[linked], y[linked])
        la, ra, lb, rb, err = (x[~small] for x in (la, ra, lb, rb, err))
        if not len(la):
            continue
        below = np.uint64(63 - d)
        bit = np.uint64(1) << below

        def middle(lows):
            return np.searchsorted(keys, ((keys[lows] >> below) | np.uint64(1)) << below)

        ma = np.clip(middle(la), la, ra)
        mb = np.clip(middle(lb), lb, rb)
        same = la == lb
        parts = [(la, ma, lb, mb, err, ma > la), (ma, ra, mb, rb, err, ra > ma),
                 (la, ma, mb, rb, err + 1, ma > la), (ma, ra, lb, mb, err + 1, (ra > ma) & ~same)]
        child = [[], [], [], [], []]
        for a0, a1, b0, b1, e, ok in parts:
            ok = ok & (b1 > b0)
            for box, x in zip(child, (a0, a1, b0, b1, e)):
                box.append(x[ok])
        stack.append((d + 1, *(np.concatenate(box) for box in child)))
    return _root(parent, np.arange(n))


def _walk_task(max_bits):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        depth, turned = int(frame["depth"].iloc[0]), int(frame["half"].iloc[0])
        keys = np.unique(frame["key"].to_numpy(np.int64).view(np.uint64))
        root = trie_links(keys, depth, max_bits)
        moved = root != np.arange(len(keys))
        u, v = keys[moved], keys[root[moved]]
        if turned:
            u, v = (x << np.uint64(32) | x >> np.uint64(32) for x in (u, v))
        return pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})
    return run


# ------------------------------------------------------------ Spark-side walk

def _prefix(depth: int):
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("long")


def links(prints: DataFrame, max_bits: int = 3, node_leaves: int = NODE_LEAVES,
          task_leaves: int = TASK_LEAVES) -> DataFrame:
    """Spanning links (u, v) of the fingerprints ``prints(fp)``, distinct and staged."""
    n = prints.count()
    depth = min(HALF, max(0, int(np.ceil(np.log2(max(n, 1) / node_leaves)))))
    turned = F.shiftleft("fp", 32).bitwiseOR(F.shiftrightunsigned("fp", 32))
    leaves = prints.select(F.explode(F.array(
        F.struct(F.lit(0).alias("half"), F.col("fp").alias("key")),
        F.struct(F.lit(1).alias("half"), turned.alias("key")))).alias("x")).select("x.*")
    nodes = leaves.groupBy("half", _prefix(depth).alias("p")).agg(F.count("*").alias("n"))
    flips = [F.col("p")] + [F.col("p").bitwiseXOR(F.lit(1 << b).cast("long"))
                            for b in range(depth if max_bits >= 2 else 0)]
    other = nodes.select("half", F.col("p").alias("b"), F.col("n").alias("nb"))
    if max_bits // 2 <= 1:
        near = nodes.select("half", F.col("p").alias("a"), F.col("n").alias("na"),
                            F.explode(F.array(*flips)).alias("b"))
        pairs = near.where("a <= b").join(other, ["half", "b"])
    else:  # wider budgets: compare the (bounded number of) top nodes with one another
        pairs = (nodes.select("half", F.col("p").alias("a"), F.col("n").alias("na"))
                 .join(other, "half").where(f"a <= b and bit_count(a ^ b) <= {max_bits // 2}"))
    tasks, work = [], None
    while True:
        pairs, _ = staged(pairs.select("half", "a", "b", "na", "nb"), "trie-pairs")
        alone = F.when(F.col("a") == F.col("b"), F.col("na")).otherwise(F.col("na") + F.col("nb"))
        heavy = pairs.where(alone > task_leaves) if depth < 64 else pairs.where("false")
        light = pairs.where(alone <= task_leaves) if depth < 64 else pairs
        members = light.select("half", "a", "b", F.explode(F.array_distinct(
            F.array("a", "b"))).alias("p"))
        dealt = (leaves.withColumn("p", _prefix(depth)).join(members, ["half", "p"])
                 .select("half", F.lit(depth).alias("depth"), "a", "b", "key"))
        tasks.append(dealt)
        if depth >= 64 or heavy.isEmpty():
            break
        depth, above = min(64, depth + STEP), depth
        budget = max_bits // 2 if depth <= HALF else max_bits
        child = (leaves.groupBy("half", _prefix(depth).alias("p")).agg(F.count("*").alias("n"))
                 .withColumn("up", F.shiftrightunsigned("p", depth - above)))
        left = child.select("half", F.col("up").alias("a"), F.col("p").alias("ca"),
                            F.col("n").alias("na"))
        right = child.select("half", F.col("up").alias("b"), F.col("p").alias("cb"),
                             F.col("n").alias("nb"))
        pairs = (heavy.select("half", "a", "b").join(left, ["half", "a"]).join(right, ["half", "b"])
                 .where("ca <= cb or a <> b")
                 .where(F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= budget)
                 .select("half", F.col("ca").alias("a"), F.col("cb").alias("b"), "na", "nb"))
    for dealt in tasks:
        work = dealt if work is None else work.union(dealt)
    return work.groupBy("half", "depth", "a", "b").applyInPandas(
        _walk_task(max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, key, text: str = "text", shingle: int = 3,
                    max_bits: int = 3, **limits) -> DataFrame:
    """(key, fp, component): ``component`` is the smallest key reachable over
    links of at most ``max_bits`` differing bits (itself included)."""
    prints, _ = staged(fingerprints(docs, key, text, shingle), "fingerprints")
    groups, _ = staged(prints.groupBy("fp").agg(F.min("key").alias("low")), "fingerprint-groups")
    stars = connected_components(links(groups.select("fp"), max_bits, **limits))
    named = (groups.join(stars.withColumnRenamed("u", "fp"), "fp", "left")
             .select("fp", "low", F.coalesce("v", "fp").alias("root")))
    smallest = named.groupBy("root").agg(F.min("low").alias("component"))
    by_print = named.join(smallest, "root").select("fp", "component")
    return prints.join(by_print, "fp").select("key", "fp", "component")


def hex16(column):
    """A long as 16 lowercase hex digits (unsigned)."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def keep_one(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` with one row left of each near-duplicate group: the smallest
    key's.  A NULL key counts as the largest.  Rows sharing that key are told
    apart by a hash over all columns (smallest stays); wholly equal rows leave
    one.  All input columns are returned unchanged."""
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                         F.struct(F.col(f"`{key}`").isNull().alias("none"),
                                  F.col(f"`{key}`").alias("id"),
                                  row_fingerprint(docs).alias("row")).alias("key"),
                         F.col("`text`").alias("text"))
    found, _ = staged(near_duplicates(marked, F.col("key"), **options), "near-duplicates")
    counted = found.groupBy("key", "component").agg(F.count("*").alias("n")).select(
        F.col("key.row").alias("row"), F.col("key.id").alias("id"), "n",
        (F.col("key") == F.col("component")).alias("stays"))
    counted, _ = staged(counted.where("not stays or n > 1"), "to-remove")
    gone = bounded_broadcast(counted.where("not stays").select("row", "id"))
    repeated = bounded_broadcast(counted.where("stays").select("row", "id"))
    match = [F.col("key.row") == F.col("row"), F.col("key.id").eqNullSafe(F.col("id"))]
    kept = marked.join(gone, match, "left_anti")
    once = kept.join(repeated, match, "left_anti").select("doc.*")
    again = kept.join(repeated, match, "left_semi").dropDuplicates(["key"]).select("doc.*")
    return once.union(again)
