import dataclasses
import math
from collections import Counter
from statistics import pvariance

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, MinMaxScaler, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from marquee.operators import metrics, regression
from marquee.schemas import PRODUCT, PRODUCT_EXCLUDED
from marquee.sources import sinks

SMALL = regression.Settings(trees=5, iterations=3)


@pytest.fixture(scope="module")
def products(spark):
    n = F.col("id")
    return spark.range(300).select(
        F.concat(F.lit("item "), (n % 7).cast("string")).alias("name"),
        F.concat(F.lit("P"), n).alias("parent_asin"),
        F.when(n % 11 != 0, n % 13 * 1.5).alias("price"),
        (n % 17).cast("double").alias("rating_number"),
        F.when(n % 23 != 0, 1 + (n % 13) / 4).alias("rating"),
        F.concat(F.lit("c"), n % 3).alias("main_category"),
        F.when(n % 5 != 0, F.concat(F.lit("s"), n % 4)).alias("store"),
    )


@pytest.mark.parametrize("name", ["lr", "random_forest", "gbt"])
def test_train_save_load_predict(spark, products, tmp_path, name):
    path, log = str(tmp_path / "model"), str(tmp_path / "metrics")
    first = regression.run("full", products, products, path, name, SMALL, log)
    again = regression.run("test", None, products, path, name, SMALL, log)
    assert first == pytest.approx(again)
    assert regression.is_saved(spark, path, name)
    predicted = regression.predict(products, path, name, SMALL)
    assert predicted.count() == products.count()
    assert predicted.filter("rating_prediction is null or isnan(rating_prediction)").count() == 0
    assert sinks.read_metrics(spark, log).count() == 2
    rated = products.dropna(subset=["rating"])
    spread = rated.agg(F.stddev_pop("rating")).first()[0]
    assert first["rmse"] < spread


def test_unknown_names(spark, products, tmp_path):
    with pytest.raises(ValueError, match="unknown model"):
        regression.train(products, str(tmp_path), "svm")
    with pytest.raises(ValueError, match="unknown mode"):
        regression.run("later", products, products, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        regression.predict(products, str(tmp_path / "none"), "lr")


def test_features_equal_one_stage_for_each_column(spark, products):
    """Weighting and scaling all columns together gives the vector of separate stages."""
    rows = regression.prepare(products, {"price": 0.0, "rating_number": 0.0}, SMALL, {})
    stages, inputs = [], []
    for c in SMALL.text:
        stages += [
            Tokenizer(inputCol=c, outputCol=f"{c}_w"),
            HashingTF(inputCol=f"{c}_w", outputCol=f"{c}_r", numFeatures=500),
            IDF(inputCol=f"{c}_r", outputCol=f"{c}_f"),
        ]
        inputs.append(f"{c}_f")
    for c in SMALL.numeric:
        stages += [
            VectorAssembler(inputCols=[c], outputCol=f"{c}_v", handleInvalid="skip"),
            MinMaxScaler(inputCol=f"{c}_v", outputCol=f"{c}_s"),
        ]
        inputs.append(f"{c}_s")
    stages.append(VectorAssembler(inputCols=inputs, outputCol="expected"))
    expected = Pipeline(stages=stages).fit(rows).transform(rows).select("parent_asin", "expected")
    fill = regression.fill_values(products, SMALL.numeric, SMALL.fill)
    model = regression.feature_pipeline(SMALL).fit(regression.prepare(products, fill, SMALL, {}))
    got = model.transform(rows).select("parent_asin", "features").join(expected, "parent_asin")
    same = F.expr("forall(zip_with(a, b, (x, y) -> abs(x - y) < 1e-9), z -> z)")
    arrays = got.select(vector_to_array("features").alias("a"), vector_to_array("expected").alias("b"))
    assert arrays.filter(~same).count() == 0 and arrays.count() == 300


def test_rows_without_a_number_are_skipped_unless_filled(spark, products):
    model = Pipeline(stages=regression.numeric_stages(["price"], "scaled")).fit(products)
    scaled = model.transform(products).select(vector_to_array("scaled")[0].alias("x"))
    assert scaled.count() == products.dropna(subset=["price"]).count()
    assert scaled.agg(F.min("x"), F.max("x")).first() == (0.0, 1.0)


def test_fitted_fill_is_applied_at_predict(spark, products, tmp_path):
    settings = dataclasses.replace(SMALL, fill="mean")
    fitted = regression.train(products, str(tmp_path), "lr", settings)
    loaded = regression.load(spark, str(tmp_path), "lr")
    rated = products.dropna(subset=["rating"])
    assert loaded.fill == fitted.fill
    assert loaded.fill["price"] == pytest.approx(rated.agg(F.mean("price")).first()[0])
    gaps = products.filter("price is null")
    assert regression.score(gaps, loaded, settings).count() == gaps.count() > 0


def test_categories(spark, products, tmp_path):
    settings = dataclasses.replace(SMALL, category=("main_category", "store"))
    fitted = regression.fit(products, "lr", settings)
    unseen = products.withColumn("store", F.lit("never seen"))
    assert regression.score(unseen, fitted, settings).count() == 300
    regression.save(spark, fitted, str(tmp_path), "lr")
    loaded = regression.load(spark, str(tmp_path), "lr")
    both = regression.score(products, fitted, settings).select("parent_asin", "rating_prediction")
    again = regression.score(products, loaded, settings).select("parent_asin", "rating_prediction")
    assert sorted(both.collect()) == sorted(again.collect())
    missing = products.withColumn("store", F.lit(None).cast("string"))
    encoded = regression.fit(missing, "lr", settings)
    assert regression.score(products, encoded, settings).count() == 300


def test_product_schema():
    assert not set(PRODUCT.fieldNames()) & set(PRODUCT_EXCLUDED)


def murmur3(data: bytes, seed: int = 42) -> int:
    """The hash of the term stage: 32-bit murmur3, signed."""
    mask, h = 0xFFFFFFFF, seed

    def scramble(k):
        k = k * 0xCC9E2D51 & mask
        return (k << 15 | k >> 17) * 0x1B873593 & mask

    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h ^= scramble(int.from_bytes(data[i : i + 4], "little"))
        h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    if whole < len(data):
        h ^= scramble(int.from_bytes(data[whole:], "little"))
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


def test_hashed_weights_by_a_twin(spark):
    texts = ["red apple red", "green apple", "red pear tree house", "", "ünïcode apple words of many letters"]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    fitted = Pipeline(stages=regression.text_stages(["text"], "out")).fit(docs)
    got = {r.i: dict(enumerate(r.v)) for r in fitted.transform(docs).select("i", vector_to_array("out").alias("v")).collect()}
    bags = []
    for text in texts:
        bag = Counter(murmur3(w.encode()) % regression.TERM_BUCKETS for w in text.lower().split(" "))
        bags.append(bag)
    df = Counter(b for bag in bags for b in bag)
    for i, bag in enumerate(bags):
        want = {b: n * math.log((len(texts) + 1) / (df[b] + 1)) for b, n in bag.items()}
        assert {b: w for b, w in got[i].items() if w} == pytest.approx({b: w for b, w in want.items() if w})


def test_a_constant_model_explains_nothing(spark):
    rows = spark.range(50).select("id", (F.col("id") % 7).cast("double").alias("y"))
    mean = rows.agg(F.mean("y")).first()[0]
    constant = rows.withColumn("p", F.lit(mean))
    assert metrics.against_mean(constant, "y", "p").first().asDict() == {
        "n": 50, "variance": pytest.approx(pvariance([i % 7 for i in range(50)])), "explains": False, "centred": True,
    }
    assert not metrics.against_mean(rows.withColumn("p", F.lit(4.0)), "y", "p").first().centred
    good = metrics.against_mean(rows.withColumn("p", F.col("y") + F.rand(1) / 100), "y", "p").first()
    assert good.explains and good.centred
    assert not metrics.against_group_means(constant, "id", "y", "p").first().better
    grouped = constant.withColumn("g", F.col("id") % 2)
    assert not metrics.against_group_means(grouped, "g", "y", "p").first().better
    assert metrics.against_group_means(grouped.withColumn("p", F.col("y")), "g", "y", "p").first().better


def test_many_categories_stay_out_of_the_schema(spark, tmp_path):
    """The schema says how long the vectors are, whatever the number of categories; a vector that
    comes before is kept, and the number after the last is a vector without a one."""
    n = 200_000
    nominal = {"ml_attr": {"type": "nominal", "num_vals": n + 1, "name": "c_number"}}
    rows = spark.createDataFrame([(0.0,), (n - 1.0,), (float(n),)], "c double")
    rows = rows.select(F.col("c").alias("c_number", metadata=nominal), F.lit(2.0).alias("x"))
    fitted = Pipeline(stages=regression.category_stages(["c"], "encoded")).fit(rows)
    fitted.write().save(str(tmp_path / "stages"))
    encoded = PipelineModel.load(str(tmp_path / "stages")).transform(rows)
    assert len(encoded.schema.json()) < 2_000
    assert fitted.stages[-1].categorySizes == [n + 1]
    got = [(v.size, v.indices.tolist()) for (v,) in encoded.orderBy("c_number").select("encoded").collect()]
    assert got == [(n, [0]), (n, [n - 1]), (n, [])]
    stages = [VectorAssembler(inputCols=["x"], outputCol="v"), *regression.category_stages(["c"], "w", "v")]
    both = Pipeline(stages=stages).fit(rows).transform(rows)
    assert len(both.schema.json()) < 2_000
    assert [v.indices.tolist() for (v,) in both.orderBy("c_number").select("w").collect()] == [[0, 1], [0, n], [0]]
    with pytest.raises(Exception, match="no number"):
        fitted.transform(rows.withColumn("c_number", F.lit(n + 1.0))).collect()


def test_tasks_of_fitting_take_so_many_rows(spark, products, monkeypatch):
    """Partitions of what a model is fitted on grow in number, not in size."""
    seen = []

    class Model:
        def fit(self, vectors):
            seen.append([n for (n,) in vectors.groupBy(F.spark_partition_id()).count().select("count").collect()])

    monkeypatch.setitem(regression.MODELS, "gbt", ("gbt_model", lambda s: Model(), None))
    monkeypatch.setattr(regression, "FIT_ROWS", 50)
    rated = products.dropna(subset=["rating"]).count()
    for category in ((), ("main_category", "store")):
        regression.fit(products.coalesce(2), "gbt", dataclasses.replace(SMALL, category=category))
        assert sum(seen[-1]) == rated and max(seen[-1]) <= 2 * 50
    monkeypatch.undo()
    monkeypatch.setitem(regression.MODELS, "gbt", ("gbt_model", lambda s: Model(), None))
    regression.fit(products.coalesce(2), "gbt", SMALL)
    assert len(seen[-1]) == 2
