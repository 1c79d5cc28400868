"""Cover trees over blocks of vectors and their dual-tree search, in arrays."""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np

#: Vectors of a leaf, and children of a node, at most.
LEAF = 64
FANOUT = 32
#: Products up to this size are exact in floating point.
EXACT = 1 << 53
#: The id of a place that no vector has taken.
FREE = np.iinfo(np.int64).max


@dataclass
class Tree:
    """Vectors in the order of the leaves; node i covers rows low[i]:high[i] around center[i].

    A node's children halve its covering radius, as far as `FANOUT` centres, each the farthest from
    those before, reach; the radius that is stored is the measured one, which alone the search
    relies on, as it does on `most`, the largest norm. A node's own centre is its first child's.
    """

    ids: np.ndarray
    vectors: np.ndarray
    low: np.ndarray
    high: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    most: np.ndarray
    least_id: np.ndarray
    children: list[list[int]]

    def dump(self) -> bytes:
        return pickle.dumps(self.__dict__, protocol=5)

    @classmethod
    def load(cls, data: bytes) -> Tree:
        return cls(**pickle.loads(data))


def build(ids: np.ndarray, vectors: np.ndarray) -> Tree:
    """`vectors` holds integers, a row for each id."""
    points = vectors.astype(np.float64)
    norms = np.linalg.norm(points, axis=1)
    order = np.arange(len(ids))
    low, high, centers, radii, children = [], [], [], [], []

    def add(begin: int, end: int, center: int) -> int:
        low.append(begin)
        high.append(end)
        centers.append(center)
        gaps = np.linalg.norm(points[order[begin:end]] - points[center], axis=1)
        radii.append(float(gaps.max()))
        children.append([])
        return len(low) - 1

    # the root's centre is the vector nearest to the mean
    root = int(np.argmin(np.linalg.norm(points - points.mean(axis=0), axis=1)))
    todo = [add(0, len(ids), root)]
    while todo:
        node = todo.pop()
        begin, end = low[node], high[node]
        if end - begin <= LEAF or radii[node] == 0:
            continue
        own = order[begin:end].copy()
        nearest = np.linalg.norm(points[own] - points[centers[node]], axis=1)
        chosen, group = [centers[node]], np.zeros(len(own), np.int64)
        # children of about half a leaf at least, where radii do not fall
        most = min(FANOUT, -(-2 * (end - begin) // LEAF))
        while len(chosen) < most and nearest.max() > radii[node] / 2:
            far = int(own[np.argmax(nearest)])
            gaps = np.linalg.norm(points[own] - points[far], axis=1)
            closer = gaps < nearest
            group[closer] = len(chosen)
            nearest = np.minimum(nearest, gaps)
            chosen.append(far)
        place = np.argsort(group, kind="stable")
        order[begin:end] = own[place]
        cuts = np.searchsorted(group[place], np.arange(len(chosen) + 1))
        for k, center in enumerate(chosen):
            if cuts[k] < cuts[k + 1]:
                child = add(begin + int(cuts[k]), begin + int(cuts[k + 1]), center)
                children[node].append(child)
                todo.append(child)
    ids = ids[order]
    center = points[centers]
    return Tree(
        ids, vectors[order], np.array(low), np.array(high), center, np.array(radii),
        np.array([norms[order[a:b]].max() for a, b in zip(low, high, strict=True)]),
        np.array([ids[a:b].min() for a, b in zip(low, high, strict=True)]), children,
    )


def exact_type(queries: np.ndarray, data: np.ndarray):
    """A type in which the integer products of two sets of vectors are exact (int64 wraps)."""
    if not queries.size or not data.size:
        return np.float64
    most = float(np.abs(queries).max()) * float(np.abs(data).max()) * queries.shape[1]
    return np.float64 if most < EXACT else np.int64


class Best:
    """The k best (score, id) of each query so far; a higher score or a smaller id is better. An id
    takes one place, with its best score."""

    def __init__(self, rows: int, k: int):
        self.scores = np.full((rows, k), np.iinfo(np.int64).min, np.int64)
        self.ids = np.full((rows, k), FREE, np.int64)

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates (query row, score, id) in any order."""
        k = self.scores.shape[1]
        who = np.unique(rows)
        rows = np.concatenate((np.repeat(who, k), rows))
        scores = np.concatenate((self.scores[who].ravel(), scores))
        ids = np.concatenate((self.ids[who].ravel(), ids))
        falling = -scores.astype(np.float64) if scores.dtype != np.int64 else ~scores
        # the first of each row and id; free places all stay
        order = np.lexsort((falling, ids, rows))
        again = (rows[order][1:] == rows[order][:-1]) & (ids[order][1:] == ids[order][:-1]) & (ids[order][1:] != FREE)
        keep = order[np.concatenate(([True], ~again))]
        rows, scores, ids, falling = rows[keep], scores[keep], ids[keep], falling[keep]
        order = np.lexsort((ids, falling, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        begins = np.searchsorted(rows, who)
        take = begins[:, None] + np.arange(k)
        self.scores[who], self.ids[who] = scores[take], ids[take]


def search(queries: Tree, data: Tree, best: Best) -> int:
    """Improve `best` (rows as in `queries`) by all of `data` that can; the number of products made.

    A pair of nodes is left out if the largest product that centres, covering radii and norms allow
    is below the worst kth score in the query node, or equal to it with no smaller id in reach. Two
    bounds hold: q.d grows from the centres' product by at most |qc| dr + (|dc| + dr) qr; and it is
    (|q|^2 + |d|^2 - |q - d|^2) / 2, where the distance is at least the centres' less both radii.
    The second is the lower one for nodes nearer to each other than about their norm. In a leaf of
    queries, which may be wide, each query's own bound decides then.
    """
    kind = exact_type(queries.vectors, data.vectors)
    left, right = queries.vectors.astype(kind), data.vectors.astype(kind)

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        centers, radii = data.center[nodes], data.radius[nodes]
        own, radius = queries.center[q], queries.radius[q]
        ball = centers @ own + np.linalg.norm(own) * radii + (np.linalg.norm(centers, axis=1) + radii) * radius
        gap = np.maximum(np.linalg.norm(centers - own, axis=1) - radii - radius, 0)
        cosine = (queries.most[q] ** 2 + data.most[nodes] ** 2 - gap * gap) / 2
        reach = np.minimum(ball, cosine)
        # rounding is relative to the squares, which cancel
        return reach + 1e-9 * (queries.most[q] ** 2 + data.most[nodes] ** 2) + 1e-6

    points = queries.vectors.astype(np.float64)
    norms = np.linalg.norm(points, axis=1)
    repeats = int(np.unique(data.ids, return_counts=True)[1].max())

    def reaches(rows: np.ndarray, d: int) -> np.ndarray:
        """The same bounds for each query of a leaf, whose radius is 0."""
        ball = points[rows] @ data.center[d] + norms[rows] * data.radius[d]
        gap = np.maximum(np.linalg.norm(points[rows] - data.center[d], axis=1) - data.radius[d], 0)
        squares = norms[rows] ** 2 + data.most[d] ** 2
        return np.minimum(ball, (squares - gap * gap) / 2) + 1e-9 * squares + 1e-6

    made = 0
    todo = [(float("inf"), 0, 0)]
    while todo:
        bound, q, d = todo.pop()
        rows = slice(queries.low[q], queries.high[q])
        own = np.arange(rows.start, rows.stop)
        if np.isfinite(bound):
            worst = best.scores[rows, -1]
            at = worst.min()
            if bound < at or (np.floor(bound) == at and data.least_id[d] > best.ids[rows, -1][worst == at].max()):
                continue
        q_open, d_open = queries.children[q], data.children[d]
        if not q_open and not d_open:
            if np.isfinite(bound):
                own = own[reaches(own, d) >= best.scores[own, -1]]
            _leaves(queries, data, left, right, own, slice(data.low[d], data.high[d]), best, repeats)
            made += int(len(own) * (data.high[d] - data.low[d]))
            continue
        # open the wider node; the most promising pairs are looked at first
        if d_open and not q_open and np.isfinite(bound) and not (reaches(own, d) >= best.scores[own, -1]).any():
            continue
        if q_open and (not d_open or queries.radius[q] > data.radius[d]):
            pairs = [(float(bounds(c, np.array([d]))[0]), c, d) for c in q_open]
        else:
            pairs = [(float(b), q, c) for b, c in zip(bounds(q, np.array(d_open)), d_open, strict=True)]
        todo.extend(sorted(pairs))
    return made


def _leaves(queries, data, left, right, rows, columns, best, repeats) -> None:
    if not len(rows):
        return
    scores = (left[rows] @ right[columns].T).astype(np.int64)
    ids = data.ids[columns]
    k = best.scores.shape[1]
    floor = best.scores[rows, -1].copy()
    # the query itself may be among the first k + 1 ids, and each may have several vectors
    first = (k + 1) * repeats
    if len(ids) > first:
        floor = np.maximum(floor, np.partition(scores, -first, axis=1)[:, -first])
    hit = (scores >= floor[:, None]) & (ids[None, :] != queries.ids[rows][:, None])
    at, of = np.nonzero(hit)
    if len(at):
        best.offer(rows[at], scores[at, of], ids[of])
