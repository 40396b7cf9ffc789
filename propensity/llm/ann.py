"""Approximate nearest neighbours: one HNSW graph per shard, results merged.

Measure: largest inner product.  Appending sqrt(R^2 - |x|^2) to every vector
(R: the corpus' largest norm) gives all of them one length, so inner products
order like distances and a proximity graph is sound; queries append 0.

Index (a table, one row per shard of at most ``SHARD_ROWS`` *distinct*
vectors): every vector gets a geometric level from its hash; each layer holds
the vectors of at least that level, with neighbour lists in one flat int32
array per layer.  Lists are chosen by the HNSW diversity rule from the layer's
nearest vectors, found by blocked matrix products inside the bounded shard,
and completed with reverse links.

Search: a beam goes down the layers, a whole block of queries at a time.  All
shards answer each query; their answers merge by score.  Scores are recomputed
in double precision on the original vectors.

Equal vectors are one graph node that keeps its k + 1 smallest ids (all a
result can show), found by a salted two-step ranking, so a vector that a third
of the rows share is neither a hot task nor a hole in the graph.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components take no part; wholly repeated rows count once; only vectors of the
query's own dimension are candidates; ties go to the smaller id; fewer than k
candidates give fewer rows; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm.common import staged

SHARD_ROWS = 1 << 15
QUERY_ROWS = 1 << 14       # queries that meet a shard in one task
LINKS = 16                 # per node and layer above 0; twice that on layer 0
CANDIDATES = 48
BEAM = 64
TOP_LAYER = 64
_BLOCK = 512
_SALTS = 64


# ----------------------------------------------------------------- graph build

def _diverse(vectors, near, sims, limit):
    """HNSW selection per row: a candidate stays if it is nearer to the node
    than to every kept one; places left over go to the nearest refused."""
    rows, width = near.shape
    found = vectors[near]
    mutual = np.matmul(found, found.transpose(0, 2, 1))
    kept = np.zeros((rows, width), bool)
    for j in range(width):
        worst = np.where(kept[:, :j], mutual[:, j, :j], -np.inf).max(axis=1, initial=-np.inf)
        kept[:, j] = (sims[:, j] > worst) & (kept.sum(axis=1) < limit) & np.isfinite(sims[:, j])
    rank = np.argsort(~kept, axis=1, kind="stable")[:, :limit]
    chosen = np.take_along_axis(near, rank, 1).astype(np.int32)
    chosen[~np.isfinite(np.take_along_axis(sims, rank, 1))] = -1
    return chosen


def build_layer(vectors: np.ndarray, links: int) -> np.ndarray:
    """Neighbour lists (n x 2 links, -1 padded) of one layer."""
    n = len(vectors)
    width = min(CANDIDATES, n - 1)
    lists = np.full((n, 2 * links), -1, np.int32)
    if width < 1:
        return lists
    forward = np.full((n, min(links, width)), -1, np.int32)
    for at in range(0, n, _BLOCK):
        sims = vectors[at:at + _BLOCK] @ vectors.T
        own = np.arange(len(sims))
        sims[own, at + own] = -np.inf
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(sims, near, 1)
        order = np.lexsort((near, -value), axis=1)
        near, value = np.take_along_axis(near, order, 1), np.take_along_axis(value, order, 1)
        forward[at:at + len(sims)] = _diverse(vectors, near, value, forward.shape[1])
    lists[:, :forward.shape[1]] = forward
    # Reverse links: nearest first into the free half of the target's list.
    source = np.repeat(np.arange(n), forward.shape[1])
    target = forward.ravel()
    source, target = source[target >= 0], target[target >= 0]
    mutual = (forward[target] == source[:, None]).any(axis=1)
    source, target = source[~mutual], target[~mutual]
    value = np.einsum("ij,ij->i", vectors[source], vectors[target])
    order = np.lexsort((source, -value, target))
    source, target = source[order], target[order]
    first = np.searchsorted(target, target, side="left")
    place = np.arange(len(target)) - first
    fits = place < links
    lists[target[fits], 2 * links - 1 - place[fits]] = source[fits]
    return lists


def build_graph(vectors: np.ndarray, links: int = LINKS):
    """[(nodes, neighbours)] from layer 0 up; neighbours are node positions of the layer."""
    n = len(vectors)
    mixed = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)
    level = np.floor(-np.log((mixed.astype(np.float64) + 1) / 2.0 ** 53) / np.log(links)).astype(int)
    layers, nodes, layer = [], np.arange(n), 0
    while True:
        layers.append((nodes, build_layer(vectors[nodes], links if layer else 2 * links)))
        layer += 1
        nodes = np.flatnonzero(level >= layer)
        if len(layers[-1][0]) <= TOP_LAYER or not len(nodes):
            return layers


def _beam(queries, vectors, lists, start, width):
    """Best ``width`` nodes of one layer per query, best first, from ``start`` (-1 padded)."""
    rows, n = len(queries), len(vectors)
    width = min(width, n)
    every = np.arange(rows)[:, None]
    seen = np.zeros((rows, n + 1), bool)
    seen[:, n] = True
    begin = np.where(start < 0, n, start)
    ids = np.full((rows, max(width, begin.shape[1])), n)
    ids[:, :begin.shape[1]] = begin
    seen[every, begin] = True
    score = np.where(ids < n, np.einsum("rd,rcd->rc", queries, vectors[np.minimum(ids, n - 1)]),
                     -np.inf)
    order = np.argsort(-score, axis=1, kind="stable")[:, :width]
    ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
    done = ids >= n
    live = np.arange(rows)
    while len(live):
        first = np.argmin(done[live], axis=1)
        open_ = ~done[live, first]
        live, first = live[open_], first[open_]
        if not len(live):
            break
        done[live, first] = True
        near = lists[ids[live, first]].astype(np.int64)
        near[near < 0] = n
        fresh = ~seen[live[:, None], near]
        seen[live[:, None], near] = True
        value = np.einsum("rd,rcd->rc", queries[live], vectors[np.minimum(near, n - 1)])
        value[~fresh] = -np.inf
        better = value.max(axis=1) > score[live, -1]
        sub, near, value = live[better], near[better], value[better]
        all_ids = np.concatenate([ids[sub], near], axis=1)
        all_score = np.concatenate([score[sub], value], axis=1)
        all_done = np.concatenate([done[sub], ~np.isfinite(value)], axis=1)
        order = np.argsort(-all_score, axis=1, kind="stable")[:, :width]
        ids[sub] = np.take_along_axis(all_ids, order, 1)
        score[sub] = np.take_along_axis(all_score, order, 1)
        done[sub] = np.take_along_axis(all_done, order, 1)
    ids[~np.isfinite(score)] = -1
    return ids


def search_graph(layers, vectors, queries, beam: int = BEAM) -> np.ndarray:
    """Node ids (best first, -1 padded) per query."""
    out = []
    for at in range(0, len(queries), _BLOCK):
        block = queries[at:at + _BLOCK]
        nodes, lists = layers[-1]
        start = np.tile(np.arange(min(len(nodes), 4 * TOP_LAYER)), (len(block), 1))
        for layer in range(len(layers) - 1, -1, -1):
            nodes, lists = layers[layer]
            found = _beam(block, vectors[nodes], lists, start, beam if layer == 0 else beam // 4)
            if layer:
                below = np.full(len(vectors), -1)
                below[layers[layer - 1][0]] = np.arange(len(layers[layer - 1][0]))
                start = np.where(found >= 0, below[nodes[found]], -1)
        out.append(found)
    return np.concatenate(out)


# ----------------------------------------------------------------- Spark tasks

def _clean_batches(batches):
    for batch in batches:
        keys, data = [], []
        for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key is None or not vector or None in vector:
                continue
            value = np.array(vector, np.float64) + 0.0
            if np.isfinite(value).all() and value.any():
                keys.append(key)
                data.append(value.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(data, pa.binary())],
                                         names=["vec_id", "vector"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _build_shard(radius, links):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vector")
        exact = _matrix(frame["vector"])
        rest = np.maximum(radius - (exact * exact).sum(axis=1), 0.0)
        layers = build_graph(np.column_stack([exact, np.sqrt(rest)]).astype(np.float32), links)
        members = frame["members"].tolist()
        width = max(map(len, members))
        flat = np.full((len(members), width), -1, np.int64)
        for i, own in enumerate(members):
            flat[i, :len(own)] = own
        return pd.DataFrame({
            "dim": [frame["dim"].iloc[0]], "shard": [frame["shard"].iloc[0]],
            "n": [len(frame)], "vectors": [exact.tobytes()], "members": [flat.tobytes()],
            "layer_nodes": [[x.astype(np.int32).tobytes() for x, _ in layers]],
            "layer_lists": [[x.tobytes() for _, x in layers]]})
    return run


def _search_shard(k, beam):
    def run(key, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series([], dtype="int64"),
                              "vec_id": pd.Series([], dtype="int64"),
                              "score": pd.Series([], dtype="float64")})
        if index.empty or queries.empty:
            return empty
        row, n = index.iloc[0], int(index["n"].iloc[0])
        exact = np.frombuffer(row["vectors"], np.float64).reshape(n, -1)
        members = np.frombuffer(row["members"], np.int64).reshape(n, -1)
        layers = []
        for nodes, lists in zip(row["layer_nodes"], row["layer_lists"]):
            nodes = np.frombuffer(nodes, np.int32)
            layers.append((nodes, np.frombuffer(lists, np.int32).reshape(len(nodes), -1)))
        asked = _matrix(queries["vector"])
        ids = queries["query_id"].to_numpy(np.int64)
        found = search_graph(layers, exact.astype(np.float32), asked.astype(np.float32),
                             max(beam, k + 1))[:, :2 * k + 2]
        parts = []
        for i in range(len(ids)):
            node = found[i][found[i] >= 0]
            score = np.repeat((exact[node] * asked[i]).sum(axis=1), members.shape[1])
            vec = members[node].ravel()
            ok = (vec >= 0) & (vec != ids[i])
            score, vec = score[ok], vec[ok]
            best = np.lexsort((vec, -score))[:k]
            parts.append(pd.DataFrame({"query_id": ids[i], "vec_id": vec[best],
                                       "score": score[best]}))
        return pd.concat(parts) if parts else empty
    return run


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding",
           k: int = 20, beam: int = BEAM, shard_rows: int = SHARD_ROWS,
           query_rows: int = QUERY_ROWS, links: int = LINKS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest other rows of every row
    for which ``is_query`` (over column ``vec_id``) holds."""
    rows, _ = staged(vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"),
                                    F.col(f"`{vector}`").alias("vector"))
                     .mapInArrow(_clean_batches, "vec_id long, vector binary")
                     .distinct().withColumn("dim", (F.length("vector") / 8).cast("int")), "vectors")
    salted = Window.partitionBy("vector", F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS))).orderBy("vec_id")
    whole = Window.partitionBy("vector").orderBy("vec_id")
    nodes, _ = staged(
        rows.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= k + 1)
        .withColumn("r", F.row_number().over(whole)).where(F.col("r") <= k + 1)
        .groupBy("dim", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("members")),
        "vector-nodes")

    def squares(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(
                [float((np.frombuffer(v.as_buffer(), np.float64) ** 2).sum())
                 for v in batch.column(0)], pa.float64())], names=["s"])

    stats = nodes.select("vector").mapInArrow(squares, "s double").agg(
        F.count("*").alias("n"), F.max("s").alias("radius")).first()
    shards = max(1, -(-stats["n"] // shard_rows))
    index, _ = staged(
        nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))
        .groupBy("dim", "shard").applyInPandas(
            _build_shard(stats["radius"] or 0.0, links),
            "dim int, shard int, n long, vectors binary, members binary, "
            "layer_nodes array<binary>, layer_lists array<binary>"), "hnsw-index")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "vector", "dim")
    chunks = max(1, -(-asked.count() // query_rows))
    asked = (asked.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))))
    served = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    near = (served.groupBy("dim", "shard", "chunk")
            .cogroup(asked.groupBy("dim", "shard", "chunk"))
            .applyInPandas(_search_shard(k, beam), "query_id long, vec_id long, score double"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
