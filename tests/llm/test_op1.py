import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import covertree, topk
from marquee.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<double>, id string, score int, block int"


def brute(rows, k, asks):
    good = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.setdefault(i, set()).add(tuple(math.floor(256 * x) for x in v))
    out = []
    for q in (i for i in good if asks(i)):
        best = {}
        for v in good[q]:
            for d, others in good.items():
                for w in others:
                    if d != q and len(w) == len(v):
                        s = sum(a * b for a, b in zip(v, w, strict=True))
                        best[d] = max(best.get(d, s), s)
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(q, n + 1, d, s) for n, (d, s) in enumerate(ranked)]
    return sorted(out)


def test_blocks_ties_and_bad_rows(spark):
    r = random.Random(3)
    hot = [r.gauss(0, 1) for _ in range(6)]
    rows = [(i, [r.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, hot) for i in range(150, 260)]  # many equal vectors: ties by id
    rows += [(i, [x + r.gauss(0, 0.01) for x in hot]) for i in range(260, 330)]
    rows += [rows[10], rows[10], (20, hot), (None, hot), (400, None), (401, []), (402, [1.0, None] * 3)]
    rows += [(403, [float("nan")] * 6), (404, [float("inf")] * 6), (405, [1.0, 2.0]), (406, [2.0, 1.0]), (410, [0.5, 0.1])]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA)
    got = top_k(df, F.col("vec_id") % 5 == 0, k=5, pivots=4, block_rows=40, query_rows=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, lambda i: i % 5 == 0)
    assert top_k(df.where("vec_id < 0"), F.lit(True)).collect() == []


@pytest.mark.parametrize("scale", [1, 10**6])
def test_dual_trees_against_brute_force(scale):
    r = np.random.default_rng(1)
    points = (r.normal(size=(700, 5)) * 50 * scale).astype(np.int64)
    points[300:] = points[0] + (r.normal(size=(400, 5)) * 2 * scale).astype(np.int64)
    ids = r.permutation(700)
    data, asked = covertree.build(ids, points), covertree.build(ids[::7], points[::7])
    for tree in (data, asked):
        for i in range(len(tree.low)):
            own = tree.vectors[tree.low[i] : tree.high[i]]
            assert np.linalg.norm(own - tree.center[i], axis=1).max() <= tree.radius[i] * (1 + 1e-9)
    best = covertree.Best(len(asked.ids), 4)
    covertree.search(asked, data, best)
    for n, i in enumerate(asked.ids):
        scores = data.vectors @ asked.vectors[n]
        want = sorted((-int(s), int(j)) for s, j in zip(scores, data.ids, strict=True) if j != i)[:4]
        assert [(-int(s), int(j)) for s, j in zip(best.scores[n], best.ids[n], strict=True)] == want


def test_an_id_with_many_vectors_takes_one_place(spark):
    r = random.Random(5)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    # more vectors of one id than places, near to many queries; some of the queries repeat too
    rows += [(100 + i % 2, [4 + r.gauss(0, 0.1), *(r.gauss(0, 0.1) for _ in range(3))]) for i in range(90)]
    rows += [(i % 4, [3.0, r.gauss(0, 1), 0.0, 0.0]) for i in range(24)]
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA)
    got = top_k(df, F.col("vec_id") % 2 == 0, k=5, pivots=4, block_rows=40, query_rows=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, lambda i: i % 2 == 0)


def made_share(points, every, k):
    ids = np.arange(len(points))
    data, asked = covertree.build(ids, points), covertree.build(ids[::every], points[::every])
    best = covertree.Best(len(asked.ids), k)
    made = covertree.search(asked, data, best)
    for n, i in enumerate(asked.ids):
        scores = points @ points[i]
        want = sorted((-int(s), j) for j, s in enumerate(scores) if j != i)[:k]
        assert [(-int(s), int(j)) for s, j in zip(best.scores[n], best.ids[n], strict=True)] == want
    return made / (len(asked.ids) * len(points))


def test_products_are_left_out_where_vectors_lie_in_clusters():
    """Unit vectors of 64 dimensions: in clusters most products are left out; where all directions
    are alike no radius rules a node out, and all are made."""
    r = np.random.default_rng(6)
    middles = r.normal(size=(30, 64))
    middles /= np.linalg.norm(middles, axis=1, keepdims=True)
    near = middles[r.integers(0, 30, 3000)] + 0.02 * r.normal(size=(3000, 64))
    near /= np.linalg.norm(near, axis=1, keepdims=True)
    assert made_share(np.floor(256 * near).astype(np.int64), 50, 5) < 0.35
    alike = r.normal(size=(1500, 64))
    alike /= np.linalg.norm(alike, axis=1, keepdims=True)
    assert made_share(np.floor(256 * alike).astype(np.int64), 50, 5) > 0.9


def test_blocks_of_far_cells_are_not_paired(spark, monkeypatch):
    """Block pairs are made only of cells whose balls reach the kth score."""
    r = np.random.default_rng(8)
    middles = 4 * np.eye(8)
    rows = [(i, (middles[i % 8] + 0.05 * r.normal(size=8)).tolist()) for i in range(800)]
    kept = {}
    keep = topk.Store.keep

    def spy(self, df, label):
        kept[label] = keep(self, df, label)
        return kept[label]

    monkeypatch.setattr(topk.Store, "keep", spy)
    df = spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], SCHEMA)
    got = top_k(df, F.col("vec_id") % 50 == 0, k=5, pivots=32, block_rows=40, query_rows=4)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, lambda i: i % 50 == 0)
    cells = kept["data"].select("cell").distinct().count()
    blocks, asked = kept["data"].count(), kept["queries"].count()
    assert cells > 2 and kept["rest"].count() < blocks * asked / 2
