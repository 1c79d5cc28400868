"""Queries: feature stages, regression, collaborative filtering."""

from __future__ import annotations

import dataclasses
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators import columns, factors, metrics, recommend, regression, splits
from marquee.operators.joins import join_many_to_one
from marquee.plans.cleaning import WORDS_SQL
from marquee.plans.registry import query, table
from marquee.plans.selection import ITEM_MEAN_ERRORS, item_mean_predictions
from marquee.plans.views import RATINGS_SQL, distinct_ratings
from marquee.schemas import PRODUCT_NUMERIC
from marquee.session import materialize, scratch_path
from marquee.sources import sinks
from marquee.sources.tables import spread

RATED = recommend.Settings(user="user_id", item="item_id")


@query(
    "min_max",
    """
    SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ())
      / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 9) AS scaled
    FROM customer
    """,
)
def min_max(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    fitted = Pipeline(stages=regression.numeric_stages(["c_acctbal"], "scaled")).fit(rows)
    scaled = vector_to_array("scaled").getItem(0)
    return fitted.transform(rows).select("c_custkey", F.round(scaled, 9).alias("scaled"))


@query(
    "min_max_known",
    """
    SELECT o_orderkey, round((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()), 9) AS scaled
    FROM (SELECT o_orderkey, o_totalprice AS v FROM orders WHERE o_orderstatus <> 'P')
    """,
)
def min_max_known(spark, sf_dir):
    """Rows whose number is missing, here that of pending orders, are skipped."""
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", known)
    scaled = Pipeline(stages=regression.numeric_stages(["v"], "scaled")).fit(rows).transform(rows)
    value = F.round(vector_to_array("scaled").getItem(0), 9).alias("scaled")
    return scaled.select("o_orderkey", value)


@query(
    "linear_fit",
    """
    SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
           round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept
    FROM lineitem
    """,
)
def linear_fit(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_quantity", F.col("l_extendedprice").alias("label")
    )
    vectors = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(rows)
    model = LinearRegression().fit(vectors.select("features", "label"))
    found = [(float(model.coefficients[0]), float(model.intercept))]
    df = spark.createDataFrame(found, "slope double, intercept double")
    return df.select(F.round("slope", 4).alias("slope"), F.round("intercept", 3).alias("intercept"))


@query("metrics_log", f"SELECT 'item mean' AS model, rmse, mae, mse FROM ({ITEM_MEAN_ERRORS})")
def metrics_log(spark, sf_dir):
    """The metrics of a baseline, logged twice by one run, and read back: the log has them once."""
    path = scratch_path(spark, "metrics")
    settings = recommend.Settings(prediction="prediction")
    predictions = item_mean_predictions(spark, sf_dir)
    for _ in range(2):
        recommend.evaluate(predictions, settings, path, model="item mean", run_id="baseline")
    logged = sinks.read_metrics(spark, path)
    return logged.select("model", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "mse")])


def _split_ratings(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Held-out rows are chosen by (user, item), so users and items occur on both sides. The
    ratings are put together, and their hashes taken, once for both parts."""
    part = splits.in_train("user_id", "item_id").alias("in_train")
    rated = materialize(distinct_ratings(spark, sf_dir).select("*", part), "ratings")
    return rated.filter("in_train").drop("in_train"), rated.filter("NOT in_train").drop("in_train")


_SPLIT_SQL = f"""
  SELECT user_id, item_id, ('0x' || substr(md5('42|' || user_id || '|' || item_id), 1, 8))::BIGINT
    % 100 < 80 AS in_train
  FROM (SELECT DISTINCT user_id, item_id FROM ({RATINGS_SQL}))
"""


@query(
    "als_coverage",
    f"""
    WITH r AS ({_SPLIT_SQL})
    SELECT user_id, item_id, true AS predicted FROM r WHERE NOT in_train
      AND user_id IN (SELECT user_id FROM r WHERE in_train)
      AND item_id IN (SELECT item_id FROM r WHERE in_train)
    """,
)
def als_coverage(spark, sf_dir):
    """Held-out ratings get a prediction, never negative, exactly where both the user and the item
    were in the training rows."""
    train, test = _split_ratings(spark, sf_dir)
    path = scratch_path(spark, "als")
    recommend.train(train, path, RATED)
    predictions = recommend.predict(test, path, RATED)
    usable = (F.col("rating_prediction") >= 0) & ~F.isnan("rating_prediction")
    return predictions.select("user_id", "item_id", usable.alias("predicted"))


@query(
    "als_ranks",
    f"""
    SELECT DISTINCT user_id::VARCHAR AS user_id, rank FROM ({_SPLIT_SQL}),
      (SELECT unnest([1, 2, 3]) AS rank) WHERE in_train
    """,
)
def als_ranks(spark, sf_dir):
    """Every training user gets three different items, the best first."""
    train, _ = _split_ratings(spark, sf_dir)
    fitted = recommend.train(train, scratch_path(spark, "als"), RATED)
    top = recommend.recommend_labels(fitted, RATED, 3)
    user = Window.partitionBy("user_id")
    ranked = user.orderBy("rank")
    sound = (
        F.coalesce(F.lag("rating_prediction").over(ranked) >= F.col("rating_prediction"), F.lit(True))
        & (F.size(F.collect_set("item_id").over(user)) == F.count("item_id").over(user))
    )
    return top.withColumn("sound", sound).filter("sound").select("user_id", "rank")


@query("als_predict")
def als_predict(spark, sf_dir):
    """The settings of the small recommender: weaker regularisation, factors of any sign. The model
    is saved by the first call and loaded by the second."""
    train, test = _split_ratings(spark, sf_dir)
    settings = dataclasses.replace(RATED, reg_param=0.01, nonnegative=False)
    path = scratch_path(spark, "als")
    recommend.train(train, path, settings)
    recommend.train(train.limit(1), path, settings)
    predictions = recommend.predict(test, path, settings)
    return predictions.select("user_id", "item_id", "rating", "rating_prediction")


@query("als_topk")
def als_topk(spark, sf_dir):
    """Five items for each training user, with their predicted ratings."""
    train, _ = _split_ratings(spark, sf_dir)
    fitted = recommend.train(train, scratch_path(spark, "als"), RATED)
    return recommend.recommend_labels(fitted, RATED, 5)


@query("als_metrics")
def als_metrics(spark, sf_dir):
    """Train, predict, evaluate and log in one call."""
    train, test = _split_ratings(spark, sf_dir)
    log = scratch_path(spark, "metrics")
    recommend.run("full", train, test, scratch_path(spark, "als"), RATED, log)
    return sinks.read_metrics(spark, log).select("model", "rmse", "mae", "mse")


_LEARNS_SQL = f"""
    WITH p AS (
      SELECT item_id, rating - avg(rating) OVER (PARTITION BY item_id) AS e FROM (
        SELECT user_id, item_id, avg(rating) AS rating FROM ({RATINGS_SQL}) GROUP BY user_id, item_id)
        JOIN ({_SPLIT_SQL}) USING (user_id, item_id) WHERE in_train)
    SELECT count(*) AS n, round(avg(e * e), 6) AS item_mean_mse, true AS better FROM p
    """


@query("als_learns", _LEARNS_SQL)
def als_learns(spark, sf_dir):
    """Over its training rows the factorisation errs less than the mean of each item."""
    train, _ = _split_ratings(spark, sf_dir)
    settings = dataclasses.replace(RATED, reg_param=0.01, nonnegative=False)
    path = scratch_path(spark, "als")
    recommend.train(train, path, settings)
    told = recommend.predict(train, path, settings).select("item_id", "rating", "rating_prediction")
    told = materialize(told, "told")
    return metrics.against_group_means(told, "item_id", "rating", "rating_prediction")


@query("als_sums_learns", _LEARNS_SQL)
def als_sums_learns(spark, sf_dir):
    """The same by sums of products, where an item's ratings need not meet in one task."""
    train, _ = _split_ratings(spark, sf_dir)
    settings = dataclasses.replace(RATED, reg_param=0.01, nonnegative=False, method="sums")
    path = scratch_path(spark, "als")
    recommend.train(train, path, settings)
    told = recommend.predict(train, path, settings).select("item_id", "rating", "rating_prediction")
    told = materialize(told, "told")
    return metrics.against_group_means(told, "item_id", "rating", "rating_prediction")


@query(
    "segment_lines",
    """
    SELECT c_mktsegment || ' ' || o_orderstatus AS kind, count(*) AS n,
      round(regr_intercept(o_totalprice / 1000, c_acctbal / 1000), 5) AS intercept,
      round(regr_slope(o_totalprice / 1000, c_acctbal / 1000), 5) AS slope
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
    """,
)
def segment_lines(spark, sf_dir):
    """Half an iteration with known factors (1, balance): a line through the orders of each kind."""
    customers = table(spark, sf_dir, "customer")
    one = F.array(F.lit(1.0), F.col("c_acctbal").cast("double") / 1000)
    known = customers.select(F.col("c_custkey").alias("id"), one.alias("features"))
    segments = customers.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    orders = join_many_to_one(orders, segments, "o_custkey").select(
        "o_custkey",
        F.concat_ws(" ", "c_mktsegment", "o_orderstatus").alias("kind"),
        (F.col("o_totalprice").cast("double") / 1000).alias("price"),
    )
    sums = factors.normal_equations(orders, known, 2, "kind", "o_custkey", "price")
    sums = materialize(sums, "sums")
    lines = factors.solve(sums, 2, "kind", 0.0, False).withColumnRenamed("id", "kind")
    return join_many_to_one(lines, sums.select("kind", "n"), "kind").select(
        "kind",
        "n",
        F.round(F.col("features")[0], 5).alias("intercept"),
        F.round(F.col("features")[1], 5).alias("slope"),
    )


def _products(spark, sf_dir) -> DataFrame:
    """Parts as the product table: all text, then renamed and cast."""
    rows = spread(table(spark, sf_dir, "part"), "p_partkey").select(
        F.col("p_type").alias("main_category"),
        F.col("p_name").alias("title"),
        (F.col("p_size") / 12.5 + 1).cast("string").alias("average_rating"),
        F.when(F.col("p_type") != "PROMO", F.length("p_name").cast("string")).alias(
            "rating_number"
        ),
        F.col("p_retailprice").cast("string").alias("price"),
        F.col("p_brand").alias("store"),
        F.col("p_partkey").cast("string").alias("parent_asin"),
    )
    rows = columns.rename(rows, {"average_rating": "rating", "title": "name"})
    return columns.cast_columns(rows, PRODUCT_NUMERIC)


def _regressed(spark, sf_dir, name: str, settings: regression.Settings) -> DataFrame:
    train, test = splits.hash_split(_products(spark, sf_dir), "parent_asin")
    path = scratch_path(spark, "regression")
    regression.train(train, path, name, settings)
    predicted = regression.predict(test, path, name, settings)
    return predicted.select("parent_asin", "name", "rating", "rating_prediction")


@query("linear_predict")
def linear_predict(spark, sf_dir):
    return _regressed(spark, sf_dir, "lr", regression.Settings())


@query("forest_predict")
def forest_predict(spark, sf_dir):
    return _regressed(spark, sf_dir, "random_forest", regression.Settings(fill="mean"))


@query("boosted_predict")
def boosted_predict(spark, sf_dir):
    return _regressed(spark, sf_dir, "gbt", regression.Settings(fill="median"))


@query("category_predict")
def category_predict(spark, sf_dir):
    settings = regression.Settings(category=("main_category", "store"))
    return _regressed(spark, sf_dir, "lr", settings)


@query("regression_run_metrics")
def regression_run_metrics(spark, sf_dir):
    train, test = splits.hash_split(_products(spark, sf_dir), "parent_asin")
    log = scratch_path(spark, "metrics")
    regression.run("full", train, test, scratch_path(spark, "regression"), "lr", metrics_path=log)
    return sinks.read_metrics(spark, log).select("model", "rmse", "mae", "mse")


_LEARNERS = {
    "lr": ("lr", regression.Settings()),
    "lr with categories": ("lr", regression.Settings(category=("main_category", "store"))),
    "random forest": ("random_forest", regression.Settings(fill="mean")),
    "gbt": ("gbt", regression.Settings(fill="median")),
}


@query(
    "regression_learns",
    """
    WITH p AS (SELECT p_size / 12.5 + 1 AS rating FROM part
      WHERE ('0x' || substr(md5('42|' || p_partkey), 1, 8))::BIGINT % 100 < 80)
    SELECT model, count(*) AS n, round(var_pop(rating), 6) AS variance, true AS explains, true AS centred
    FROM p, (SELECT unnest(['lr', 'lr with categories', 'random forest', 'gbt']) AS model) GROUP BY model
    """,
)
def regression_learns(spark, sf_dir):
    """Over its training rows each model errs less than their mean, and keeps their mean."""
    train, _ = splits.hash_split(_products(spark, sf_dir), "parent_asin")
    train = materialize(train, "train")
    rows = []
    for label, (name, settings) in _LEARNERS.items():
        told = regression.score(train, regression.fit(train, name, settings), settings)
        rows.append(metrics.against_mean(told, "rating", "rating_prediction").withColumn("model", F.lit(label)))
    return reduce(DataFrame.unionByName, rows)


@query(
    "forest_range",
    f"""
    SELECT p_partkey::VARCHAR AS parent_asin, true AS in_range FROM part
    WHERE ('0x' || substr(md5('42|' || p_partkey), 1, 8))::BIGINT % 100 >= 80
    """,
)
def forest_range(spark, sf_dir):
    """A forest predicts means of training ratings, so every prediction lies among them."""
    predicted = _regressed(spark, sf_dir, "random_forest", regression.Settings())
    inside = F.col("rating_prediction").between(1.0, 5.0)
    return predicted.select("parent_asin", inside.alias("in_range"))


@query(
    "category_positions",
    """
    SELECT p_partkey, dense_rank() OVER (ORDER BY n DESC, p_brand) - 1 AS position
    FROM part JOIN (SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand) USING (p_brand)
    """,
)
def category_positions(spark, sf_dir):
    """Where the one of the one-hot vector is: the most frequent category comes first."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    stages = regression.category_stages(["p_brand"], "encoded")
    # The encoder leaves out the last position, which unseen categories share.
    numbered = regression.number_categories(rows, regression.fit_categories(rows, ["p_brand"]))
    encoded = Pipeline(stages=stages).fit(numbered).transform(numbered)
    position = F.array_position(vector_to_array("encoded"), 1.0) - 1
    return encoded.select("p_partkey", position.alias("position"))


@query(
    "many_categories",
    """
    SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderkey::VARCHAR) - 1 AS position,
           (SELECT count(DISTINCT o_orderkey) + 1 FROM orders) AS positions
    FROM orders
    """,
)
def many_categories(spark, sf_dir):
    """A category for each row, and the size of the encoder that was fitted on them."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey")
    numbered = regression.number_categories(rows, regression.fit_categories(rows, ["o_orderkey"]))
    stages = regression.category_stages(["o_orderkey"], "encoded")
    fitted = Pipeline(stages=stages).fit(numbered)
    return fitted.transform(numbered).select(
        "o_orderkey",
        F.col("o_orderkey_number").cast("bigint").alias("position"),
        F.lit(fitted.stages[0].categorySizes[0]).cast("bigint").alias("positions"),
    )


@query(
    "hashed_counts",
    f"SELECT doc_id, CAST(count(*) AS DOUBLE) AS words FROM ({WORDS_SQL}) GROUP BY doc_id",
)
def hashed_counts(spark, sf_dir):
    """Hashing loses which word it was, but no word: the counts add up to the words of the text."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    docs = docs.fillna("", subset=["text"])
    stages = regression.text_stages(["text"], "text_features")[:2]
    counts = vector_to_array(F.col("text_counts"))
    hashed = Pipeline(stages=stages).fit(docs).transform(docs)
    total = F.aggregate(counts, F.lit(0.0), lambda a, b: a + b)
    return hashed.select("doc_id", total.alias("words")).filter("words > 0")


@query("hashed_tfidf")
def hashed_tfidf(spark, sf_dir):
    """Hashed term weights of every text: one row for each bucket with a weight."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    docs = docs.fillna("", subset=["text"])
    fitted = Pipeline(stages=regression.text_stages(["text"], "text_features")).fit(docs)
    each = F.posexplode(vector_to_array("text_features")).alias("bucket", "weight")
    return fitted.transform(docs).select("doc_id", each).filter("weight <> 0")
