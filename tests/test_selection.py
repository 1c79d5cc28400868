import pytest
from conftest import plan_of, rows_of
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from marquee.operators import frequency, joins, labels, metrics, sets, splits

SPLIT = {"broadcast_bytes": -1, "piece_rows": 50}


@pytest.fixture(scope="module")
def facts(spark):
    """A third of all rows have key 7, some none, and many rows are equal copies."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 90)
    return spark.range(0, 3000, 1, 6).select(key.alias("k"), (F.col("id") % 4).alias("x"))


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.range(0, 80).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_join_equals_the_plain_join(facts, dimension, how):
    expected = facts.join(dimension, "k", how)
    for sizes in ({}, SPLIT):
        got = joins.join_many_to_one(facts, dimension, "k", how, **sizes)
        assert rows_of(got.select(*expected.columns)) == rows_of(expected)
        derived = joins.join_many_to_one(facts, dimension, "k", how, derived=True, **sizes)
        assert rows_of(derived.select(*expected.columns)) == rows_of(expected)
    counts = frequency.counts(facts, "k", name="_n")
    counted = joins.join_many_to_one(facts, dimension, "k", how, counts=counts, **SPLIT)
    assert rows_of(counted.select(*expected.columns)) == rows_of(expected)


def test_split_join_cuts_the_hot_key(spark, facts, dimension):
    marked = joins.split_join(facts, dimension, ["k"], "inner", 50)
    joined = plan_of(marked).split("Physical Plan")[1]
    assert "_piece" in joined
    # 1000 and some rows of key 7 in pieces of about 50: no piece of the join key has them all.
    many = facts.withColumn("_p", F.pmod(F.xxhash64("k", "x", F.spark_partition_id()), F.lit(21)))
    most = many.filter("k = 7").groupBy("_p").count().agg(F.max("count")).first()[0]
    assert most < 600


def test_large_side_is_not_broadcast(facts, dimension):
    assert joins.fits(dimension, 80 * 60) and not joins.fits(dimension, 80 * 48)
    assert not joins.fits(dimension, 100)
    assert joins.fits(dimension.limit(0), 0)
    small = plan_of(joins.join_many_to_one(facts, dimension, "k"))
    assert "BroadcastHashJoin" in small
    assert "_piece" in plan_of(joins.join_many_to_one(facts, dimension, "k", broadcast_bytes=100))


def test_lookup_takes_the_first_match(spark, facts):
    rows = [(7, 2, "second", "b"), (7, 1, "first", "a"), (8, 5, "only", None), (None, 0, "x", "x")]
    movies = spark.createDataFrame(rows, "k bigint, at int, title string, year string")
    for sizes in ({}, SPLIT):
        got = joins.lookup(facts, movies, "k", "at", ["title", "year"], **sizes)
        found = {(r.k, r.title, r.year) for r in got.select("k", "title", "year").collect()}
        assert found == {(7, "first", "a"), (8, "only", None)}
        assert got.count() == facts.filter("k in (7, 8)").count()


def test_frequent_values(facts):
    for sizes in ({}, SPLIT):
        kept = frequency.keep_frequent(facts, "k", 23, **sizes)
        counted = {r.k: r.n for r in frequency.counts(kept, "k", name="n").collect()}
        everything = {r.k: r.n for r in frequency.counts(facts, "k", name="n").collect()}
        assert None in everything and None not in counted
        assert counted == {k: n for k, n in everything.items() if k is not None and n >= 23}


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "v string")
    got = frequency.value_counts(df, "v", "n")
    assert [tuple(r) for r in got.collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert frequency.row_count(df).first().n == 5


def test_members(spark, facts):
    keys = spark.createDataFrame([(7,), (7,), (8,), (None,)], "k bigint")
    assert frequency.members(facts, keys, "k").count() == facts.filter("k in (7, 8)").count()


def test_frequent_item_stats(spark):
    rows = [("a", 1.0), ("a", 3.0), ("b", 5.0), ("b", None), (None, 2.0)]
    df = spark.createDataFrame(rows, "item string, rating double")
    got = frequency.frequent_item_stats(df, "item", "rating", 2)
    assert plan_of(got).split("Physical Plan")[1].count("Exchange") == 1
    assert [tuple(r) for r in got.collect()] == [("a", 2, 4.0, 2.0)]
    assert frequency.mean_of(df, "rating").first().rating == 2.75


def test_hash_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(2000)
    train, test = splits.hash_split(df, "id")
    a, b = ({r.id for r in part.collect()} for part in (train, test))
    assert a | b == set(range(2000)) and not a & b
    assert 0.75 < len(a) / 2000 < 0.85
    again, _ = splits.hash_split(df.repartition(13), "id")
    assert {r.id for r in again.collect()} == a
    other, _ = splits.hash_split(df, "id", seed=7)
    assert {r.id for r in other.collect()} != a


def test_random_split(spark):
    train, test = splits.random_split(spark.range(1000))
    assert train.count() + test.count() == 1000


def test_prefix_split(spark):
    df = spark.range(39).select(F.col("id").alias("k"), (F.col("id") % 2).alias("x"))
    train, test = splits.prefix_split(df, "k", buckets=4, few=3)
    assert [r.k for r in train.orderBy("k").collect()] == list(range(31))
    assert [r.k for r in test.orderBy("k").collect()] == list(range(31, 39))
    assert rows_of(test) == rows_of(df.subtract(train))
    none, everything = splits.prefix_split(df, "k", 0.01)
    assert none.count() == 0 and everything.count() == 39


def test_difference(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (3, "c")], "x int, y string")
    right = spark.createDataFrame([(3, "c"), (9, "z")], "x int, y string")
    got = sets.difference(left, right)
    assert rows_of(got) == rows_of(left.subtract(right)) == [(1, "a"), (2, None)]
    assert sets.difference(left, left).count() == 0
    bag = sets.difference(left, right, keep_copies=True)
    assert rows_of(bag) == [(1, "a"), (1, "a"), (2, None), (3, "c")]
    assert "Join" not in plan_of(got).split("Physical Plan")[1]


def test_union_of_feeds(spark):
    a = spark.createDataFrame([(1, "x")], "p int, q string")
    b = spark.createDataFrame([(2.5,)], "r double")
    got = sets.union_feeds({"a": a, "b": b})
    assert rows_of(got.select("p", "q", "r", "feed")) == [(None, None, 2.5, "b"), (1, "x", None, "a")]


def test_errors_equal_the_evaluator(spark):
    df = spark.range(50).select(
        (F.col("id") * 1.0).alias("y"), (F.col("id") * 1.1 - 2).cast("float").alias("p")
    )
    got = metrics.errors(df, "y", "p")
    for name, value in got.items():
        one = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert value == pytest.approx(one.evaluate(df.withColumn("p", F.col("p").cast("double"))))
    assert got["mse"] == pytest.approx(got["rmse"] ** 2)


def test_nothing_to_evaluate(spark):
    df = spark.createDataFrame([(None, 1.0), (2.0, float("nan"))], "y double, p double")
    assert metrics.errors(df, "y", "p") is None
    assert metrics.error_frame(df, "y", "p").first().n == 0


LABELS = ["b", "a", "b", "c", "a", "Ä", "z", None]


def test_index_equals_the_ml_indexer(spark):
    df = spark.createDataFrame([(x,) for x in LABELS], "v string")
    model = StringIndexer(inputCol="v", outputCol="i").fit(df.dropna())
    index = labels.fit_index(df, "v")
    assert {r.label: r.idx for r in index.collect()} == {x: i for i, x in enumerate(model.labels)}


def test_unseen_labels(spark, tmp_path):
    df = spark.createDataFrame([(x,) for x in LABELS], "v string")
    path = str(tmp_path / "index")
    labels.save_index(labels.fit_index(df, "v"), path)
    index = labels.load_index(spark, path)
    new = spark.createDataFrame([("b",), ("new",), (None,)], "v string")
    for sizes in ({}, SPLIT):
        kept = labels.apply_index(new, index, "v", "i", "keep", **sizes)
        model = StringIndexer(inputCol="v", outputCol="j", handleInvalid="keep").fit(df.dropna())
        same = model.transform(kept)
        assert same.filter("i != j").count() == 0 and same.count() == 3
        assert labels.apply_index(new, index, "v", "i", "skip", **sizes).count() == 1
        again = labels.apply_index(df.dropna(), index, "v", "i", "error", same_rows=True, **sizes)
        assert again.count() == 7
        with pytest.raises(Exception, match="unseen label in v"):
            labels.apply_index(new, index, "v", "i", "error", **sizes).collect()
    back = labels.restore_labels(kept, index, "i", "label")
    assert [r.label for r in back.collect()] == ["b"]
    with pytest.raises(ValueError):
        labels.apply_index(new, index, "v", "i", "guess")
