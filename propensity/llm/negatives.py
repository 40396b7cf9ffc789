"""Hard-negative mining over a distributed multiway hyperplane tree (see ``gnat``).

Score: integer inner product of the vectors' components floor(scale * x).  Every
anchor has its ``positives`` nearest other rows of its label; for each of them the
best ``negatives`` rows of other labels score within [low %, high %] of it.

1. Equal vectors of one label are one node that keeps its smallest ids (all a
   result can show), so copies neither swell a task nor the tree.
2. Root: up to ``ROOT_POINTS`` split points of a bounded sample (``ROOT_SAMPLE``
   nodes and ``ROOT_BYTES`` a dimension).  Every node goes to its nearest one's
   cell; the distance ranges from each point to each cell are one small aggregate.
   Cells over ``SHARD_BYTES`` are cut by hash into shards, each of which holds a
   tree of its own, stored as flat arrays.
3. Each search (positives first, then the windows that they set) has two steps: the
   home shard gives every query a lower bound; then the query goes to those other
   shards that its annulus can meet by the root's ranges, and their trees eliminate
   and scan.  Answers are merged by (score, id).  Nothing is approximate: eliminated
   cells cannot hold an answer, so the result equals an exhaustive search.

Defined cases: rows with a NULL id, label or vector, or a NULL or non-finite
component take no part, nor do rows whose squared integer norm is 2^55 or more (a
bound on a score would leave 64 bits); vectors of different lengths are not
compared; wholly repeated rows (id, label, vector) count once, rows that share an id
only are different rows; a positive score under 0 has no window; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propensity.llm import gnat
from propensity.llm.common import staged

ROOT_POINTS = 64
ROOT_SAMPLE = 1 << 10
ROOT_BYTES = 16 << 20
SHARD_BYTES = 16 << 20
SHARD_LEAST = 1 << 11      # rows under which a shard is not worth cutting for parallelism
QUERY_BYTES = 8 << 20
NORM_LIMIT = float(1 << 55)
_SALTS = 64


def _clean(scale: float):
    def run(batches):
        for batch in batches:
            out = []
            for key, label, vector in zip(*(c.to_pylist() for c in batch.columns)):
                if key is None or label is None or vector is None or None in vector:
                    continue
                value = np.array(vector, np.float64)
                if not np.isfinite(value).all():
                    continue
                value = np.floor(value * scale)
                if not (value * value).sum() < NORM_LIMIT:
                    continue
                out.append((key, label, len(vector), value.astype("<i8").tobytes()))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                names=["vec_id", "label", "dim", "vector"])
    return run


def _matrix(column, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), "<i8").reshape(len(column), dim)


def _nodes(rows: DataFrame, keep: int) -> DataFrame:
    """(dim, label, vector, node, members): the ``keep`` smallest ids of each different row."""
    whole = ["dim", "label", "vector"]
    salted = Window.partitionBy(*whole, F.pmod(F.xxhash64("vec_id"), F.lit(_SALTS))).orderBy("vec_id")
    together = Window.partitionBy(*whole).orderBy("vec_id")
    return (rows.withColumn("_r", F.row_number().over(salted)).where(F.col("_r") <= keep)
            .withColumn("_r", F.row_number().over(together)).where(F.col("_r") <= keep)
            .groupBy(*whole).agg(F.sort_array(F.collect_list("vec_id")).alias("members"))
            .withColumn("node", node_key()))


def node_key() -> Column:
    """One text per different (label, vector)."""
    return F.md5(F.concat(F.col("label").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("vector")))


# ----------------------------------------------------------------- the root

def _root_points(nodes: DataFrame, sizes: dict) -> dict:
    """dim -> lifted split points; {} for a dimension with one cell."""
    points = {}
    for dim, (count, radius2, cells) in sizes.items():
        if cells < 2:
            continue
        sample = (nodes.where(F.col("dim") == dim)
                  .orderBy(F.xxhash64("node"), "node").limit(max(1, min(ROOT_SAMPLE, ROOT_BYTES // (8 * dim + 8))))
                  .select("vector").toPandas())
        lifted = gnat.lift(_matrix(sample["vector"], dim), radius2)
        points[dim] = lifted[gnat.split_points(lifted, cells)]
    return points


def _cell_of(points: dict, radius: dict):
    """Adds each node's cell: the nearest split point."""
    def run(batches):
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int32)
            for dim, at in _by_dim(batch.column("dim")):
                if dim in points:
                    lifted = gnat.lift(_matrix(batch.column("vector").take(pa.array(at)).to_pylist(), dim), radius[dim])
                    cell[at] = gnat.distances(lifted, points[dim]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, "cell"])
    return run


def _by_dim(column):
    dims = column.to_numpy(zero_copy_only=False)
    for dim in np.unique(dims):
        yield int(dim), np.flatnonzero(dims == dim)


def _cell_ranges(points: dict, radius: dict):
    """Per task: smallest and largest distance from every split point to every cell."""
    def run(batches):
        low, high = {}, {}
        for batch in batches:
            for dim, at in _by_dim(batch.column("dim")):
                if dim not in points:
                    continue
                lifted = gnat.lift(_matrix(batch.column("vector").take(pa.array(at)).to_pylist(), dim), radius[dim])
                cell = batch.column("cell").to_numpy()[at]
                lo, hi = gnat.ranges(gnat.distances(lifted, points[dim]), cell, len(points[dim]))
                low[dim] = np.minimum(low.get(dim, lo), lo)
                high[dim] = np.maximum(high.get(dim, hi), hi)
        for dim, lo in low.items():
            i, j = np.nonzero(np.isfinite(lo))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dim, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                 pa.array(lo[i, j]), pa.array(high[dim][i, j])], names=["dim", "point", "cell", "low", "high"])
    return run


# ----------------------------------------------------------------- shards

def _build_shard(radius: dict):
    def run(key, frame):
        dim = int(key[0])
        frame = frame.sort_values("node")
        vectors, labels = _matrix(frame["vector"], dim), frame["label"].to_numpy(np.int64)
        members = frame["members"].tolist()
        width = max(map(len, members))
        ids = np.full((len(members), width), -1, np.int64)
        held = np.zeros(len(members), np.int64)
        for i, own in enumerate(members):
            ids[i, :len(own)], held[i] = own, len(own)
        tree = gnat.build(vectors, labels, radius[dim])
        blob = gnat.pack(vectors=vectors, labels=labels, ids=ids, held=held,
                         node=np.array(frame["node"].tolist(), "S32"), **tree)
        return pd.DataFrame({"dim": [dim], "cell": [int(key[1])], "part": [int(key[2])], "tree": [blob]})
    return run


ANSWER = "query string, slot int, vec_id long, node string, score long"


def _search_shard(radius: dict, same: bool, k: int):
    def run(key, index, asked):
        nothing = pd.DataFrame({"query": pd.Series([], dtype=object), "slot": pd.Series([], dtype="int32"),
                                "vec_id": pd.Series([], dtype="int64"), "node": pd.Series([], dtype=object),
                                "score": pd.Series([], dtype="int64")})
        if index.empty or asked.empty:
            return nothing
        dim = int(key[0])
        tree = gnat.unpack(index["tree"].iloc[0])
        widths = asked["low"].map(len).to_numpy()
        unit_query = np.repeat(np.arange(len(asked)), widths)
        low, high = (np.concatenate(asked[c].tolist()).astype(np.int64) for c in ("low", "high"))
        slots = np.concatenate([np.asarray(s, np.int64) for s in asked["slots"]])
        unit, score, row = gnat.search(
            tree, tree["vectors"], tree["labels"], tree["ids"][:, 0] if len(tree["ids"]) else tree["held"],
            radius[dim], _matrix(asked["vector"], dim), asked["label"].to_numpy(np.int64), unit_query,
            low, high, same, k)
        if not len(unit):
            return nothing
        # Nodes become their ids: all that are held, best k of a unit.
        times = tree["held"][row]
        who, value, at = np.repeat(unit, times), np.repeat(score, times), np.repeat(row, times)
        nth = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times)
        ids = tree["ids"][at, nth] if len(at) else np.zeros(0, np.int64)
        order = np.lexsort((ids, -value, who))
        who, value, at, ids = who[order], value[order], at[order], ids[order]
        keep = np.arange(len(who)) - np.searchsorted(who, who, side="left") < k
        who, value, at, ids = who[keep], value[keep], at[keep], ids[keep]
        return pd.DataFrame({"query": asked["query"].to_numpy()[unit_query[who]], "slot": slots[who].astype(np.int32),
                             "vec_id": ids, "node": [n.decode() for n in tree["node"][at]], "score": value})
    return run


class Forest:
    """The staged tree: cells, shards, and searches over them."""

    def __init__(self, nodes: DataFrame):
        spark = nodes.sparkSession
        parallel = spark.sparkContext.defaultParallelism

        def squares(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([float((np.frombuffer(v.as_buffer(), "<i8").astype(float) ** 2).sum())
                                                for v in batch.column(1)], pa.float64())], names=["dim", "square"])

        known = (nodes.select("dim", "vector").mapInArrow(squares, "dim int, square double")
                 .groupBy("dim").agg(F.count("*").alias("n"), F.max("square").alias("r")).collect())
        self.rows, sizes = {}, {}
        for r in known:
            most = max(1, SHARD_BYTES // (8 * r["dim"] + 64))
            self.rows[r["dim"]] = max(1, min(most, max(SHARD_LEAST, -(-r["n"] // (2 * parallel)))))
            # As many points as shards, within the bytes that a task is handed.
            cells = min(ROOT_POINTS, -(-r["n"] // self.rows[r["dim"]]), max(1, ROOT_BYTES // (8 * r["dim"] + 8)))
            sizes[r["dim"]] = (r["n"], r["r"], cells)
        self.radius = {d: s[1] for d, s in sizes.items()}
        self.points = _root_points(nodes, sizes)
        placed = nodes.select("node", "dim", "label", "vector", "members").mapInArrow(
            _cell_of(self.points, self.radius), "node string, dim int, label long, vector binary, "
            "members array<long>, cell int")
        placed, _ = staged(placed, "gnat-cells")
        counted = placed.groupBy("dim", "cell").agg(F.count("*").alias("n")).collect()
        self.parts = {(r["dim"], r["cell"]): -(-r["n"] // self.rows[r["dim"]]) for r in counted}
        self.low = {d: np.full((len(p), len(p)), np.inf) for d, p in self.points.items()}
        self.high = {d: np.full((len(p), len(p)), -np.inf) for d, p in self.points.items()}
        for r in (placed.select("dim", "cell", "vector").mapInArrow(
                    _cell_ranges(self.points, self.radius), "dim int, point int, cell int, low double, high double")
                  .groupBy("dim", "point", "cell").agg(F.min("low").alias("low"), F.max("high").alias("high"))
                  .collect()):                          # at most ROOT_POINTS squared rows a dimension
            self.low[r["dim"]][r["point"], r["cell"]] = r["low"]
            self.high[r["dim"]][r["point"], r["cell"]] = r["high"]
        parts = F.lit(1)
        for dim_cell, count in self.parts.items():
            if count > 1:
                parts = F.when((F.col("dim") == dim_cell[0]) & (F.col("cell") == dim_cell[1]), count).otherwise(parts)
        self.placed = placed.withColumn("part", F.pmod(F.xxhash64("node"), parts).cast("int"))
        index = self.placed.groupBy("dim", "cell", "part").applyInPandas(
            _build_shard(self.radius), "dim int, cell int, part int, tree binary")
        self.index, _ = staged(index, "gnat-shards")

    def _away(self, asked: DataFrame) -> DataFrame:
        """Queries x the shards, but their own, that an annulus of theirs can meet."""
        points, radius, low, high, parts = self.points, self.radius, self.low, self.high, self.parts
        carried, cells = ["query", "dim", "label", "vector", "slots", "low", "high"], {}
        for dim, cell in parts:
            cells.setdefault(dim, []).append(cell)

        def run(batches):
            for batch in batches:
                frame = pa.Table.from_batches([batch]).to_pandas()
                home = [(c, p) for c, p in zip(frame["cell"], frame["part"])]
                out = {"row": [], "cell": [], "part": []}
                for dim, own in frame.reset_index(drop=True).groupby("dim"):
                    vectors = _matrix(own["vector"], dim)
                    reach = np.ones((len(own), max(cells[dim]) + 1), bool)
                    if dim in points:
                        lifted = np.column_stack([vectors.astype(float), np.zeros(len(vectors))])
                        dist, square = gnat.distances(lifted, points[dim]), (lifted * lifted).sum(axis=1)
                        reach[:] = False
                        widths = own["low"].map(len).to_numpy()
                        unit = np.repeat(np.arange(len(own)), widths)
                        lo, hi = (np.concatenate(own[c].tolist()).astype(np.int64) for c in ("low", "high"))
                        near, far = gnat.annulus(square[unit], radius[dim], lo, hi)
                        keep = gnat.alive(dist[unit], near, far, low[dim], high[dim]) & (lo <= hi)[:, None]
                        np.logical_or.at(reach, unit, keep)
                    for i, at in enumerate(own.index):
                        for cell in cells[dim]:
                            if reach[i, cell]:
                                for part in range(parts[(dim, cell)]):
                                    if (cell, part) != home[at]:
                                        out["row"].append(at)
                                        out["cell"].append(cell)
                                        out["part"].append(part)
                if out["row"]:
                    rows = pa.array(out["row"], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(c).take(rows) for c in carried),
                         pa.array(out["cell"], pa.int32()), pa.array(out["part"], pa.int32())],
                        names=[*carried, "cell", "part"])

        return asked.select(*carried, "cell", "part").mapInArrow(
            run, "query string, dim int, label long, vector binary, slots array<int>, low array<long>, "
                 "high array<long>, cell int, part int")

    def _ask(self, asked: DataFrame, chunks: int, same: bool, k: int) -> DataFrame:
        asked = asked.withColumn("chunk", F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int"))
        served = self.index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
        by = ["dim", "cell", "part", "chunk"]
        return (served.groupBy(*by).cogroup(asked.groupBy(*by))
                .applyInPandas(_search_shard(self.radius, same, k), ANSWER))

    def best(self, queries: DataFrame, same: bool, k: int) -> DataFrame:
        """(query, slot, vec_id, node, score), the best ``k`` per query and slot.
        ``queries``: query (its node), dim, label, vector, cell, part, slots, low, high
        (arrays, a window of scores per slot)."""
        top = Window.partitionBy("query", "slot").orderBy(F.desc("score"), "vec_id", "node")
        best = lambda found: found.withColumn("_r", F.row_number().over(top)).where(F.col("_r") <= k).drop("_r")
        size = queries.agg(F.sum(F.length("vector") + 32 * F.size("slots") + 128).alias("b")).first()["b"] or 0
        chunks = max(1, -(-size // QUERY_BYTES))
        home, _ = staged(self._ask(queries, chunks, same, k), "gnat-home")
        # A full answer at home raises the lower end of its window.
        bound = (home.groupBy("query", "slot").agg(F.count("*").alias("n"), F.min("score").alias("least"))
                 .where(F.col("n") >= k).groupBy("query")
                 .agg(F.map_from_entries(F.collect_list(F.struct("slot", "least"))).alias("bounds")))
        raised = F.zip_with("slots", "low", lambda s, lo: F.coalesce(F.greatest(
            lo, F.try_element_at("bounds", s)), lo))
        tight = queries.join(bound, "query", "left").withColumn("low", F.when(
            F.col("bounds").isNull(), F.col("low")).otherwise(raised)).drop("bounds")
        far, _ = staged(self._ask(self._away(tight), chunks, same, k), "gnat-far")
        return best(home.unionByName(far))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50,
         high: int = 95, scale: float = 256.0, key: str = "vec_id", label: str = "label",
         vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for every
    row for which ``is_anchor`` (over column ``vec_id``) holds."""
    rows, _ = staged(vectors.select(F.col(f"`{key}`").cast("long").alias("vec_id"),
                                    F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{vector}`").alias("vector"))
                     .mapInArrow(_clean(scale), "vec_id long, label long, dim int, vector binary"), "gnat-rows")
    nodes, _ = staged(_nodes(rows, max(positives + 1, negatives)), "gnat-nodes")
    forest = Forest(nodes)
    anchors, _ = staged(rows.where(is_anchor).select("vec_id", node_key().alias("query")).distinct(), "gnat-anchors")
    asking, _ = staged(
        forest.placed.join(anchors.select(F.col("query").alias("node")).distinct(), "node", "left_semi")
        .select(F.col("node").alias("query"), "dim", "label", "vector", "cell", "part"), "gnat-queries")
    whole = asking.select("*", F.array(F.lit(0)).alias("slots"), F.array(F.lit(gnat.LOWEST)).alias("low"),
                          F.array(F.lit(gnat.HIGHEST)).alias("high"))
    near, _ = staged(forest.best(whole, True, positives + 1), "gnat-positives")
    # A window per different positive score of a query.
    windows = (near.groupBy("query", "score").agg(F.count("*").alias("n"))
               .select("query", "score",
                       F.expr(f"(score * {low}) div 100 + if((score * {low}) % 100 > 0, 1, 0)").alias("least"),
                       F.expr(f"(score * {high}) div 100 - if((score * {high}) % 100 < 0, 1, 0)").alias("most"))
               .where(F.col("least") <= F.col("most"))
               .withColumn("slot", F.row_number().over(Window.partitionBy("query").orderBy("score")) - 1))
    windows, _ = staged(windows.withColumn("slot", F.col("slot").cast("int")), "gnat-windows")
    per_query = windows.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("slot", "least", "most"))).alias("w"))
    narrow = asking.join(per_query, "query").select(
        "query", "dim", "label", "vector", "cell", "part", F.col("w.slot").alias("slots"),
        F.col("w.least").alias("low"), F.col("w.most").alias("high"))
    narrow, _ = staged(narrow, "gnat-window-queries")
    found = (forest.best(narrow, False, negatives)
             .withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score", "node": "_other"})
             .join(windows.select("query", "slot", F.col("score").alias("positive_score")), ["query", "slot"]))
    # Per anchor: the first ``positives`` rows but itself.
    order = Window.partitionBy("anchor_id", "query").orderBy(F.desc("score"), "vec_id", "node")
    pairs = (anchors.withColumnRenamed("vec_id", "anchor_id").join(near, "query")
             .where((F.col("vec_id") != F.col("anchor_id")) | (F.col("node") != F.col("query")))
             .withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= positives)
             .select("query", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("node").alias("_own"),
                     F.col("score").alias("positive_score")))
    place = Window.partitionBy("anchor_id", "query", "positive_id", "_own").orderBy(
        F.desc("negative_score"), "negative_id", "_other")
    return (pairs.join(found, ["query", "positive_score"])
            .withColumn("rank", F.row_number().over(place))
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
