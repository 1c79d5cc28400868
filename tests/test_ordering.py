import random

import pytest
from conftest import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.operators import nulls, ordering

TINY = {"buckets": 3, "few": 2}


def brute_cut(pairs, budget):
    """Greatest value whose rows, with all earlier ones, fit; rows of equal value go together."""
    total, last = 0, None
    by_value = {}
    for v, w in pairs:
        by_value[v] = by_value.get(v, 0) + w
    for v in sorted(by_value):
        if total + by_value[v] > budget:
            return last, v
        total += by_value[v]
        last = v
    return last, None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.one_of(st.integers(-50, 50), st.integers(-(2**63), 2**63 - 1)), st.integers(0, 9)
        ),
        max_size=40,
    ),
    st.integers(0, 150),
)
def test_cut_of_whole_numbers(spark, pairs, budget):
    df = spark.createDataFrame(pairs, "v bigint, w int")
    assert ordering._walk(df, budget, 3, 2) == brute_cut(pairs, budget)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.floats(allow_nan=False, allow_infinity=False), st.integers(0, 9)), max_size=40
    ),
    st.integers(0, 150),
)
def test_cut_of_floats(spark, pairs, budget):
    pairs = [(v + 0.0, w) for v, w in pairs]
    df = spark.createDataFrame(pairs, "v double, w int")
    assert ordering._walk(df, budget, 3, 2) == brute_cut(pairs, budget)


def test_cut_needs_a_number(spark):
    df = spark.createDataFrame([("a",)], "k string")
    with pytest.raises(TypeError):
        ordering.cut_value(df, "k", F.lit(1), 1)


@pytest.mark.parametrize("rank", [1, 2, 250, 500, 999, 1000])
def test_value_at_rank(spark, rank):
    rng = random.Random(rank)
    numbers = [rng.choice([1, 2, 3, rng.random() * 1000]) * 1.0 for _ in range(1000)]
    df = spark.createDataFrame([(n,) for n in numbers], "x double")
    assert ordering.value_at_rank(df, "x", rank, buckets=8, few=5) == sorted(numbers)[rank - 1]


def test_prefix_is_a_filter(spark):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") * 7919 % 1009).alias("k"), "id")
    keys = sorted(r.k for r in df.collect())
    got = ordering.ordered_prefix(df, "k", 300, **TINY)
    assert sorted(r.k for r in got.collect()) == keys[:300]
    assert "Exchange" not in plan_of(got)
    assert ordering.ordered_prefix(df, "k", 0).count() == 0
    assert ordering.ordered_prefix(df, "k", 5000).count() == 1000


def test_byte_prefix(spark):
    rng = random.Random(1)
    texts = [(i * 3, "é" * rng.randint(0, 30)) for i in range(200)]
    rng.shuffle(texts)
    df = spark.createDataFrame(texts, "k bigint, t string").repartition(4)
    for budget in (0, 10, 777, 3000, 10**9):
        used, expected = 0, []
        for k, t in sorted(texts):
            used += len(t.encode())
            if used > budget:
                break
            expected.append(k)
        got = ordering.byte_prefix(df, "k", "t", budget, **TINY)
        assert sorted(r.k for r in got.collect()) == expected
    got = ordering.byte_prefix(df, "k", "t", 777)
    sizes = {k: len(t.encode()) for k, t in texts}
    kept = [r.k for r in got.collect()]
    following = min(k for k in sizes if k not in kept)
    assert sum(sizes[k] for k in kept) <= 777 < sum(sizes[k] for k in kept) + sizes[following]


def test_rank_and_running_total(spark):
    rng = random.Random(2)
    data = [(rng.randint(0, 5), f"n{i}", rng.randint(0, 100)) for i in range(500)]
    df = spark.createDataFrame(data, "a int, b string, w int").repartition(7)
    expected, total = [], 0
    for at, (a, b, w) in enumerate(sorted(data, key=lambda r: (-r[0], r[1])), 1):
        total += w
        expected.append((a, b, w, at, total))
    order = [F.desc("a"), F.asc("b")]
    ranked = ordering.with_rank(df, order, "rank")
    summed = ordering.with_running_total(df, order, F.col("w"), "upto")
    both = ranked.join(summed, ["a", "b", "w"]).select("a", "b", "w", "rank", "upto")
    assert rows_of(both) == sorted(expected, key=lambda r: tuple((True, str(v)) for v in r))


def test_first_rows_and_top_per_group(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 1000).alias("x"))
    assert [r.x for r in ordering.first_rows(df, 4, [F.desc("x")]).collect()] == [999, 998, 997, 996]
    top = ordering.top_per_group(df, ["g"], [F.desc("x")], 2)
    assert top.count() == 6
    assert "WindowGroupLimit" in plan_of(top).split("Physical Plan")[1]


def test_fills(spark):
    numbers = [1.0, None, 4.0, float("nan"), 7.0, 100.0]
    df = spark.createDataFrame([(n, 2.0) for n in numbers], "x double, y double")
    assert nulls.fill_values(df, ["x", "y"], "constant") == {"x": 0.0, "y": 0.0}
    assert nulls.fill_values(df, ["x", "y"], "mean") == {"x": 28.0, "y": 2.0}
    assert nulls.fill_values(df, ["x", "y"], "median") == {"x": 4.0, "y": 2.0}
    assert nulls.fill_values(df, ["x", "y"], "exact_median") == {"x": 4.0, "y": 2.0}
    filled = nulls.fill_missing(df, ["x"], "mean")
    assert sorted(r.x for r in filled.collect()) == [1.0, 4.0, 7.0, 28.0, 28.0, 100.0]
    with pytest.raises(ValueError, match="unknown strategy"):
        nulls.fill_values(df, ["x"], "mode")


def test_empty_column_has_no_mean(spark):
    df = spark.createDataFrame([(None,)], "x double")
    for strategy in ("mean", "median", "exact_median"):
        assert nulls.fill_values(df, ["x"], strategy) == {}
    assert nulls.fill_missing(df, ["x"], "mean").first().x is None


def test_drop_missing(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    assert nulls.drop_missing(df).count() == 1
    assert nulls.drop_missing(df, ["x"]).count() == 2
