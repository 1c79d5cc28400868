import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import whitening
from marquee.llm.registered import QUERIES
from marquee.llm.whitening import by_length, cross_products, whiten, whole

SCHEMA = "vec_id long, embedding array<double>, row string, N string, length int"


@pytest.mark.parametrize("spread", [1, 300, 10**6, 2**50, 2**62])
def test_cross_products_are_exact(spread):
    r = random.Random(spread)
    for n, d in ((1, 1), (63, 3), (64, 2), (65, 4), (200, 5)):
        rows = [[r.randrange(-spread, spread + 1) if j else 7 for j in range(d)] for _ in range(n)]
        sums, products = cross_products(np.array(rows, np.int64))
        assert sums.tolist() == [sum(v[j] for v in rows) for j in range(d)]
        assert products.tolist() == [[sum(v[j] * v[k] for v in rows) for k in range(d)] for j in range(d)]


def test_parts_add_up():
    for value in (0, 1, -1, 2**32, -(2**95) + 5, 3**80):
        assert sum(p << (whitening.PART_BITS * i) for i, p in enumerate(whitening._parts(value))) == value


def test_vectors_that_take_part():
    column = pa.array([[9.0], [1.0, 2.0], None, [], [1.0, None], [math.nan, 1.0], [math.inf], [3.0], [4.0, 5.0]]).slice(1)
    got = {v.shape[1]: (rows.tolist(), v.tolist()) for rows, v in by_length(column)}
    assert got == {1: ([6], [[3.0]]), 2: ([0, 7], [[1.0, 2.0], [4.0, 5.0]])}
    assert whole(np.array([0.0, -0.0001, 1e300])).tolist() == [100000, 99999, 2**62 + 100000]


def brute(vectors, components):
    x = [[math.floor(1024 * c) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(v[j] for v in x) for j in range(d)]
    off = [[n * v[j] - s[j] for j in range(d)] for v in x]
    cov = np.array([[float(Fraction(sum(o[j] * o[k] for o in off), n**3)) for k in range(d)] for j in range(d)])
    values, columns = np.linalg.eigh(cov)
    best = np.argsort(-values)[:components]
    w = np.array(off, float) / n @ columns[:, best] / np.sqrt(values[best])
    return [sum(o * o for o in row) for row in off], w, values[best] / np.trace(cov)


def test_against_brute_force(spark, monkeypatch):
    r = np.random.default_rng(5)
    scale = np.array([3.0, 2.0, 1.0, 0.5, 0.1])
    vectors = (r.normal(size=(300, 5)) * scale + [0, 5, 0, -7, 0]).tolist()
    vectors += [vectors[0]] * 150  # many equal rows
    rows = [(i, v) for i, v in enumerate(vectors)] + [(None, vectors[1]), (5, vectors[2]), (5, vectors[2])]
    vectors = [v for _, v in rows]
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0]), (903, [math.nan] * 5), (904, [math.inf] * 5)]
    short = [(1000 + i, [float(i), float(i % 3)]) for i in range(20)]
    single = [(1100, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame([(i, v, "x", "old", 1) for i, v in rows + bad + short + single], SCHEMA)
    monkeypatch.setattr(whitening, "HELD", 10)
    got = whiten(df.repartition(5), components=3).collect()
    assert set(got[0].asDict()) == {"vec_id", "embedding", "row", "length", "n", "deviation", "whitened", "explained", "identity_error"}
    assert len(got) == len(rows) + 21
    for given, k in ((vectors, 3), ([v for _, v in short], 2)):
        deviations, w, explained = brute(given, 3)
        own = [g for g in got if len(g.embedding) == len(given[0])]
        by_vector = {tuple(g.embedding): g for g in own}
        signs = np.sign(by_vector[tuple(given[0])].whitened / w[0])
        for v, dev, row in zip(given, deviations, w, strict=True):
            g = by_vector[tuple(v)]
            assert g.n == len(given) and int(g.deviation) == dev
            assert g.whitened == pytest.approx(row * signs, rel=1e-6, abs=1e-9) and len(g.whitened) == k
            assert g.explained == pytest.approx(explained, rel=1e-9) and g.identity_error < 1e-6
    (one,) = [g for g in got if g.vec_id == 1100]
    assert one.n == 1 and one.whitened == [None] * 3 and one.explained is None and int(one.deviation) == 0
    assert whiten(df.limit(0)).collect() == []


def test_few_rows_and_large_entries(spark):
    rows = [(i, [1e200 if i % 2 else -1e200, float(i), 2.0]) for i in range(4)]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), carry=["vec_id"]).collect()
    assert len(got) == 4 and all(g.whitened[0] is not None and g.whitened[2] is None for g in got)
    assert all(g.deviation is None for g in got)  # over 38 digits


def test_query(spark, sf_dir):
    got = QUERIES["op13_whitening"](spark, sf_dir)
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").where(F.col("embedding").isNotNull()).collect()
    given = [g for g in given if all(v is not None and math.isfinite(v) for v in g.embedding)]
    deviations, w, explained = brute([g.embedding for g in given], 8)
    rows = {(r.vec_id, r.component): r for r in got.collect()}
    assert len(rows) == 8 * len(given)
    for c in range(8):
        sign = math.copysign(1, rows[given[0].vec_id, c + 1].whitened * w[0][c])
        for i, g in enumerate(given):
            r = rows[g.vec_id, c + 1]
            assert r.whitened == pytest.approx(sign * w[i][c], rel=1e-6, abs=1e-8) and r.deviation == deviations[i]
            assert r.explained == pytest.approx(explained[c], rel=1e-9) and r.n == len(given)
            assert r.identity_error < 1e-6
