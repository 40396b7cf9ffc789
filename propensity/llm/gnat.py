"""A multiway hyperplane tree (GNAT) over integer vectors, searched in blocks.

Every row x is lifted to one length R by a last coordinate sqrt(R^2 - |x|^2); a
query a gets 0 there.  Then |a - x|^2 = |a|^2 + R^2 - 2 a.x, so a window of inner
products is an annulus round the query, and the triangle inequality holds.

A node of the tree deals its rows to the nearest of a few split points (the cells
are bounded by hyperplanes) and keeps, for every pair of a split point i and a
child j, the smallest and largest distance from point i to the rows of child j.  A
child is passed over when for some i no distance that its range allows meets the
query's annulus, or when its labels cannot answer.  Leaves are scanned exactly.

Everything is numpy on one shard of bounded bytes; products of integers whose norms
stay under 2^26 are exact in doubles, larger ones are taken in 64-bit integers.
"""

from __future__ import annotations

import io

import numpy as np

ARITY = 16
LEAF_ROWS = 256
EXACT_DOUBLE = float(1 << 52)
LOWEST, HIGHEST = np.iinfo(np.int64).min // 4, np.iinfo(np.int64).max // 4
_SAMPLE = 512


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products (int64) of the rows of two int64 matrices."""
    if not len(a) or not len(b) or not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    x, y = a.astype(np.float64), b.astype(np.float64)
    if (x * x).sum(axis=1).max() * (y * y).sum(axis=1).max() < EXACT_DOUBLE ** 2:
        return np.rint(x @ y.T).astype(np.int64)
    return a @ b.T


def lift(vectors: np.ndarray, radius2: float) -> np.ndarray:
    x = vectors.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(radius2 - (x * x).sum(axis=1), 0.0))])


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances between two sets of (lifted) points."""
    square = ((queries * queries).sum(axis=1)[:, None] + (points * points).sum(axis=1)[None, :]
              - 2.0 * (queries @ points.T))
    return np.sqrt(np.maximum(square, 0.0))


def split_points(points: np.ndarray, count: int) -> np.ndarray:
    """Positions of up to ``count`` different, far-apart rows (greedy farthest first)."""
    chosen = [0]
    near = distances(points, points[:1])[:, 0]
    while len(chosen) < count:
        far = int(near.argmax())
        if near[far] <= 0:
            break
        chosen.append(far)
        near = np.minimum(near, distances(points, points[far:far + 1])[:, 0])
    return np.array(chosen)


def ranges(dist: np.ndarray, cell: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest distance from every split point (column) to every cell's rows."""
    low, high = np.full((dist.shape[1], count), np.inf), np.full((dist.shape[1], count), -np.inf)
    for j in range(count):
        own = dist[cell == j]
        if len(own):
            low[:, j], high[:, j] = own.min(axis=0), own.max(axis=0)
    return low, high


def annulus(square: np.ndarray, radius2: float, low: np.ndarray, high: np.ndarray):
    """(nearest, farthest) distance at which a score in [low, high] lies; ``square``: |a|^2."""
    base = square + radius2
    slack = 1e-6 * np.sqrt(np.maximum(base, 1.0))
    near = np.sqrt(np.maximum(base - 2.0 * high.astype(np.float64), 0.0)) - slack
    far = np.sqrt(np.maximum(base - 2.0 * low.astype(np.float64), 0.0)) + slack
    return near, far


def alive(dist: np.ndarray, near: np.ndarray, far: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(queries x cells): whether the annulus can meet a cell, by all split points' ranges."""
    keep = np.ones((len(dist), low.shape[1]), bool)
    slack = 1e-7
    for i in range(dist.shape[1]):
        d = dist[:, i][:, None]
        keep &= ((d - far[:, None] <= high[i] * (1 + slack)) & (d + far[:, None] >= low[i] * (1 - slack))
                 & (d + high[i] * (1 + slack) >= near[:, None]))
    return keep & np.isfinite(low).any(axis=0)


# ------------------------------------------------------------------ one shard

def build(vectors: np.ndarray, labels: np.ndarray, radius2: float, arity: int = ARITY,
          leaf: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """The tree as flat arrays: ``order`` (rows by leaf), per node its span in it and
    its children; split points and ranges of inner nodes back to back."""
    lifted = lift(vectors, radius2)
    points, lows, highs = [], [], []
    spans, kids = [[0, 0]], [[-1, 0, 0]]                # kids: first child, children, first split point
    order = np.arange(len(vectors))
    work = [(0, 0, len(vectors))]
    while work:
        node, start, stop = work.pop()
        spans[node] = [start, stop]
        own = order[start:stop]
        if len(own) <= leaf:
            continue
        sample = own[np.linspace(0, len(own) - 1, min(_SAMPLE, len(own))).astype(int)]
        at = sample[split_points(lifted[sample], arity)]
        if len(at) < 2:
            continue
        dist = distances(lifted[own], lifted[at])
        cell = dist.argmin(axis=1)
        low, high = ranges(dist, cell, len(at))
        order[start:stop] = own[np.argsort(cell, kind="stable")]
        ends = start + np.cumsum(np.bincount(cell, minlength=len(at)))
        kids[node] = [len(spans), len(at), sum(map(len, points))]
        points.append(at)
        lows.append(low.ravel())
        highs.append(high.ravel())
        for j in range(len(at)):
            work.append((len(spans), ends[j - 1] if j else start, ends[j]))
            spans.append([0, 0])
            kids.append([-1, 0, 0])
    flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
    return {"order": order, "spans": np.array(spans, np.int64), "kids": np.array(kids, np.int64),
            "points": flat(points, np.int64), "low": flat(lows, float), "high": flat(highs, float)}


def pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob)) as found:
        return {k: found[k] for k in found.files}


class Best:
    """Per unit the ``k`` best (score, then smaller id) rows met so far."""

    def __init__(self, units: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()            # floor: a score under it cannot enter
        self.unit, self.score, self.first, self.row = (np.zeros(0, np.int64) for _ in range(4))

    def offer(self, unit, score, first, row):
        unit, score = np.concatenate([self.unit, unit]), np.concatenate([self.score, score])
        first, row = np.concatenate([self.first, first]), np.concatenate([self.row, row])
        order = np.lexsort((first, -score, unit))
        unit, score, first, row = unit[order], score[order], first[order], row[order]
        place = np.arange(len(unit)) - np.searchsorted(unit, unit, side="left")
        keep = place < self.k
        last = place == self.k - 1
        self.floor[unit[last]] = np.maximum(self.floor[unit[last]], score[last])
        self.unit, self.score, self.first, self.row = unit[keep], score[keep], first[keep], row[keep]


def search(tree: dict, vectors, labels, first_ids, radius2, queries, query_labels, unit_query, low, high,
           same: bool, k: int):
    """Best rows per unit: (unit, score, row) with low <= score <= high and a label
    equal to (``same``) or other than the query's.  ``unit_query``: the query of a unit."""
    lifted = lift(vectors, radius2)
    asked = np.column_stack([queries.astype(np.float64), np.zeros(len(queries))])
    square = (asked * asked).sum(axis=1)
    best = Best(len(unit_query), k, low)
    order, spans, kids = tree["order"], tree["spans"], tree["kids"]
    ranges_at = _range_offsets(kids)
    work = [(0, np.flatnonzero(low <= high))]
    while work:
        node, units = work.pop()
        start, stop = spans[node]
        rows = order[start:stop]
        if not len(rows) or not len(units):
            continue
        here = np.unique(labels[rows])
        asks = query_labels[unit_query[units]]
        fits = np.isin(asks, here) if same else (len(here) > 1) | (asks != here[0])
        units = units[fits & (best.floor[units] <= high[units])]
        if not len(units):
            continue
        first, count, point = kids[node]
        if first < 0:
            _scan(best, vectors, labels, first_ids, queries, query_labels, unit_query, high, same, rows, units)
            continue
        points = lifted[tree["points"][point:point + count]]
        lo = tree["low"][ranges_at[node]:ranges_at[node] + count * count].reshape(count, count)
        hi = tree["high"][ranges_at[node]:ranges_at[node] + count * count].reshape(count, count)
        who = unit_query[units]
        unique, back = np.unique(who, return_inverse=True)
        dist = distances(asked[unique], points)[back]
        near, far = annulus(square[who], radius2, best.floor[units], high[units])
        keep = alive(dist, near, far, lo, hi)
        # The child whose point is nearest on the whole comes off the stack first.
        for j in np.argsort(-dist.mean(axis=0), kind="stable"):
            work.append((first + j, units[keep[:, j]]))
    return best.unit, best.score, best.row


def _range_offsets(kids) -> np.ndarray:
    """Where the ranges of each inner node start: they were written with the split
    points, count values of which lie before ``point``."""
    inner = [(point, node, count) for node, (first, count, point) in enumerate(kids) if first >= 0]
    at, out = 0, np.zeros(len(kids), np.int64)
    for _, node, count in sorted(inner):
        out[node] = at
        at += count * count
    return out


_CELLS = 1 << 22


def _scan(best, vectors, labels, first_ids, queries, query_labels, unit_query, high, same, rows, units):
    step = max(1, _CELLS // max(1, len(rows)))
    for at in range(0, len(units), step):
        part = units[at:at + step]
        who = unit_query[part]
        unique, back = np.unique(who, return_inverse=True)
        score = products(queries[unique], vectors[rows])[back]
        match = labels[rows][None, :] == query_labels[who][:, None]
        good = (match if same else ~match) & (score >= best.floor[part][:, None]) & (score <= high[part][:, None])
        u, r = np.nonzero(good)
        if len(u):
            best.offer(part[u], score[u, r], first_ids[rows[r]], rows[r])
