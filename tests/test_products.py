from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import joins, products, recommend
from marquee.operators.products import top_products

SCHEMA = "id int, features array<float>"


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], SCHEMA)


def brute(users, items, k):
    out = set()
    for u, v in users:
        scores = sorted((-float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float))), i) for i, w in items)
        out |= {(u, n + 1, i, round(-s, 9)) for n, (s, i) in enumerate(scores[:k])}
    return out


def found(top):
    return {(r.user, r["rank"], r.item, round(r.score, 9)) for r in top.collect()}


def multiplied(top):
    return top.agg(F.sum("multiplied")).first()[0]


@pytest.mark.parametrize("k", [1, 4, 500])
def test_equal_to_all_pairs(spark, k):
    r = np.random.default_rng(k)
    users = [(i, r.normal(size=3)) for i in range(90)] + [(100, [0, 0, 0]), (101, [1e-20, 0, 0])]
    items = [(i, r.normal(size=3) * 2.0 ** -(i % 12)) for i in range(300)] + [(i, [1, 1, 1]) for i in range(300, 330)]
    top = top_products(vectors(spark, users), vectors(spark, items), k, block_items=16, block_users=20)
    assert found(top) == brute(users, items, k)


def test_most_products_are_left_out(spark):
    """Norms fall by a power law, as those of rarely rated items do under regularisation."""
    r = np.random.default_rng(3)
    users = [(i, r.normal(size=8)) for i in range(400)]
    items = [(i, r.normal(size=8) * (i + 1) ** -0.5) for i in range(3000)]
    top = top_products(vectors(spark, users), vectors(spark, items), 5, block_items=64, block_users=100)
    assert found(top) == brute(users, items, 5)
    assert multiplied(top) < 0.15 * len(users) * len(items)


def test_empty_sides(spark):
    some, none = vectors(spark, [(1, [1, 2])]), vectors(spark, [])
    assert top_products(some, none, 3).collect() == []
    assert top_products(none, some, 3).collect() == []


def test_recommendations_are_those_of_the_library(spark, tmp_path):
    pairs = spark.range(1200).select(
        (F.col("id") % 40).alias("u"), (F.col("id") / 40).cast("int").alias("i")
    )
    rating = (1 + F.col("u") % 3) * (1 + F.col("i") % 7) + F.col("u") * F.col("i") % 5
    settings = recommend.Settings(user="u", item="i", max_iter=4)
    fitted = recommend.train(pairs.withColumn("rating", rating.cast("double")), str(tmp_path), settings)
    own = recommend.recommend(fitted, settings, 6)
    theirs = fitted.model.recommendForAllUsers(6)
    assert own.schema.simpleString() == theirs.schema.simpleString()
    got = {r.u_index: [(x.i_index, x.rating) for x in r.recommendations] for r in own.collect()}
    want = {r.u_index: [(x.i_index, x.rating) for x in r.recommendations] for r in theirs.collect()}
    assert got.keys() == want.keys()
    for user, best in want.items():
        assert [x for _, x in got[user]] == pytest.approx([x for _, x in best], rel=1e-5)


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_a_round_of_one_block_is_spread_over_tasks(spark, monkeypatch, limit):
    """All users meet the first item block; their products are not computed in the task of its key."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        users = spark.range(640).select("id", F.array(F.lit(1.0)).alias("features"), F.lit(-1.0).alias("need"))
        parts = products.materialize(products._user_blocks(users, 10), "parts")
        span = products.materialize(products.item_blocks(vectors(spark, [(1, [1.0]), (2, [0.5])]), 2), "span")
        met = products._pairs(parts, span, 0, 1, 16)
        tasks = Counter(row[0] for row in met.select(F.spark_partition_id()).collect())
        assert sum(tasks.values()) == parts.count() and max(tasks.values()) <= sum(tasks.values()) / 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_later_rounds_give_only_what_reaches_the_kth_score(spark, monkeypatch):
    """All norms are alike, so every product is computed; of later blocks only those pairs are passed
    on that are among a user's k best so far, and rounds are bounded."""
    r = np.random.default_rng(8)
    users, items = (r.normal(size=(n, 4)) for n in (40, 640))
    items /= np.linalg.norm(items, axis=1)[:, None]
    rows = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, features array<double>") for x in (users, items)]
    spans, passed = [], []
    pairs, stored = products._pairs, products.top_per_group
    monkeypatch.setattr(products, "ROUND_BLOCKS", 4)
    monkeypatch.setattr(products, "_pairs", lambda parts, span, first, last, tasks: spans.append(last - first) or pairs(parts, span, first, last, tasks))
    monkeypatch.setattr(products, "top_per_group", lambda df, *rest: passed.append(df) or stored(df, *rest))
    seen = []
    keep = products.materialize
    monkeypatch.setattr(products, "materialize", lambda df, label: (label == "best" and seen.append(passed[-1].count())) or keep(df, label))
    found = products.top_products(*rows, 3, block_items=32, block_users=16).collect()
    assert spans == [1, 2, 4, 4, 4, 4, 1]
    # each round's rows: the three best so far, and of the new ones what reaches the third of them
    assert max(seen) < 40 * 3 * 4 < 40 * 3 * 5
    scores = users @ items.T
    for u in range(40):
        assert [x.item for x in sorted((x for x in found if x.user == u), key=lambda x: x.rank)] == np.argsort(-scores[u])[:3].tolist()
    assert sum(x.multiplied for x in found) == 40 * 640
