"""Rating regression on text and numeric features."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    MinMaxScaler,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.operators import versions
from marquee.operators.encoding import CategoryVectors
from marquee.operators.labels import apply_index, fit_index, load_index, save_index
from marquee.operators.metrics import errors
from marquee.operators.nulls import apply_fill, fill_values
from marquee.operators.recommend import MODES
from marquee.session import materialize
from marquee.sources.sinks import log_metrics

TERM_BUCKETS = 500
TREES = 100
# Rows of one task of fitting. Trees keep a number for each feature of each row, some kilobytes.
FIT_ROWS = 10_000


@dataclass(frozen=True)
class Settings:
    text: tuple[str, ...] = ("name", "parent_asin")
    numeric: tuple[str, ...] = ("price", "rating_number")
    category: tuple[str, ...] = ()
    label: str = "rating"
    prediction: str = "rating_prediction"
    fill: str = "constant"
    seed: int = 52
    trees: int = TREES
    iterations: int = 20
    depth: int = 5


@dataclass(frozen=True)
class Fitted:
    fill: dict[str, float]
    features: PipelineModel
    model: object
    indexes: dict[str, DataFrame] = field(default_factory=dict)


def _linear(s: Settings):
    return LinearRegression(labelCol=s.label, predictionCol=s.prediction)


def _forest(s: Settings):
    return RandomForestRegressor(
        labelCol=s.label, predictionCol=s.prediction, numTrees=s.trees, maxDepth=s.depth,
        seed=s.seed,
    )


def _boosted(s: Settings):
    return GBTRegressor(
        labelCol=s.label, predictionCol=s.prediction, maxIter=s.iterations, maxDepth=s.depth,
        seed=s.seed,
    )


# Model names and the folders they are saved in.
MODELS: dict[str, tuple[str, Callable, type]] = {
    "lr": ("linear_regression_model", _linear, LinearRegressionModel),
    "random_forest": ("random_forest_model", _forest, RandomForestRegressionModel),
    "gbt": ("gbt_model", _boosted, GBTRegressionModel),
}


def choose(name: str) -> tuple[str, Callable, type]:
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; supported: {', '.join(MODELS)}")
    return MODELS[name]


def text_stages(columns: Sequence[str], output: str, buckets: int = TERM_BUCKETS) -> list:
    """Words and hashed term counts of each column; all counts are weighted by rarity together,
    which gives the same weights as one weighting for each column but reads the rows once."""
    stages: list = []
    for c in columns:
        stages.append(Tokenizer(inputCol=c, outputCol=f"{c}_words"))
        stages.append(
            HashingTF(inputCol=f"{c}_words", outputCol=f"{c}_counts", numFeatures=buckets)
        )
    counts = [f"{c}_counts" for c in columns]
    return stages + [
        VectorAssembler(inputCols=counts, outputCol=f"{output}_counts"),
        IDF(inputCol=f"{output}_counts", outputCol=output),
    ]


def numeric_stages(columns: Sequence[str], output: str) -> list:
    """The columns as a vector, each scaled to [0, 1]; rows with a missing value are skipped."""
    raw = f"{output}_raw"
    return [
        VectorAssembler(inputCols=list(columns), outputCol=raw, handleInvalid="skip"),
        MinMaxScaler(inputCol=raw, outputCol=output),
    ]


def category_stages(columns: Sequence[str], output: str, after: str | None = None) -> list:
    """One-hot vectors of the numbers that `number_categories` gives, behind the vector `after`."""
    return [CategoryVectors([f"{c}_number" for c in columns], output, after)]


def feature_pipeline(settings: Settings) -> Pipeline:
    """Text features, then numbers, then categories, in one vector."""
    stages, inputs = [], []
    for make, output, columns in (
        (text_stages, "text_features", settings.text),
        (numeric_stages, "number_features", settings.numeric),
    ):
        if columns:
            stages += make(columns, output)
            inputs.append(output)
    if not settings.category:
        return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features")])
    # The assembler names every entry of a vector, of which categories may have any number.
    if inputs:
        stages.append(VectorAssembler(inputCols=inputs, outputCol="plain_features"))
    after = "plain_features" if inputs else None
    return Pipeline(stages=[*stages, *category_stages(settings.category, "features", after)])


def fit_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """The label index of each column, written once. It is a table, so that there may be any number
    of categories; the encoder's model holds their number only."""
    return {c: materialize(fit_index(df, c), "categories") for c in columns}


def number_categories(df: DataFrame, indexes: dict[str, DataFrame]) -> DataFrame:
    """Add the number of each category, the most frequent one being 0. Missing and unseen ones
    share the number after the last, which the encoder leaves out."""
    for column, index in indexes.items():
        size = index.agg(F.max("idx")).collect()[0][0]
        values = (-1 if size is None else size) + 2
        name = f"{column}_number"
        df = apply_index(df, index, column, name)
        attribute = {"ml_attr": {"type": "nominal", "num_vals": max(values, 2), "name": name}}
        df = df.withColumn(name, F.col(name).cast("double").alias(name, metadata=attribute))
    return df


def prepare(
    df: DataFrame, fill: dict[str, float], settings: Settings, indexes: dict[str, DataFrame]
) -> DataFrame:
    """Fill numbers with the fitted values and missing text with the empty string, and number the
    categories. An empty category counts as missing."""
    filled = _known(apply_fill(df, fill).fillna("", subset=list(settings.text)), settings)
    return number_categories(filled, indexes)


def _known(df: DataFrame, settings: Settings) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in settings.category})


def fit(df: DataFrame, name: str, settings: Settings = Settings()) -> Fitted:
    """Fit features and model on the rows that have a label."""
    _, make, _ = choose(name)
    used = [*settings.text, *settings.numeric, *settings.category, settings.label]
    rows = df.select(*used).dropna(subset=[settings.label]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fill = fill_values(rows, settings.numeric, settings.fill)
        indexes = fit_categories(_known(rows, settings), settings.category)
        prepared = prepare(rows, fill, settings, indexes)
        features = feature_pipeline(settings).fit(prepared)
        # The model reads its rows many times; words are cut and hashed once for all of them.
        vectors = features.transform(prepared).select("features", settings.label)
        vectors = _in_pieces(vectors, rows, settings).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = make(settings).fit(vectors)
        finally:
            vectors.unpersist()
    finally:
        rows.unpersist()
    return Fitted(fill, features, model, indexes)


def _in_pieces(vectors: DataFrame, rows: DataFrame, settings: Settings) -> DataFrame:
    """The vectors of `rows` with about `FIT_ROWS` in a partition at most; few rows stay where they
    are. Categories are joined, which may leave fewer partitions than the rows have."""
    wanted, parts = rows.count() // FIT_ROWS + 1, rows.rdd.getNumPartitions()
    if wanted > parts or (settings.category and wanted > 1):
        return vectors.repartition(max(wanted, parts))
    return vectors


def score(df: DataFrame, fitted: Fitted, settings: Settings = Settings()) -> DataFrame:
    prepared = prepare(df, fitted.fill, settings, fitted.indexes)
    return fitted.model.transform(fitted.features.transform(prepared))


def _paths(folder: str) -> dict[str, str]:
    return {part: f"{folder}/{part}" for part in ("fill", "categories", "features", "model")}


def _model_dir(save_dir: str, name: str) -> str:
    """Each kind of model has versions of its own."""
    return f"{save_dir}/{choose(name)[0]}"


def is_saved(spark: SparkSession, save_dir: str, name: str) -> bool:
    return versions.current(spark, _model_dir(save_dir, name)) is not None


def save(spark: SparkSession, fitted: Fitted, save_dir: str, name: str) -> None:
    """Fill values, categories, stages and model become current together."""
    versions.publish(spark, _model_dir(save_dir, name), lambda path: _write(spark, fitted, path))


def _write(spark: SparkSession, fitted: Fitted, folder: str) -> None:
    paths = _paths(folder)
    rows = spark.createDataFrame(list(fitted.fill.items()), "column string, value double")
    rows.write.parquet(paths["fill"])
    names = spark.createDataFrame([(c,) for c in fitted.indexes], "column string")
    names.write.parquet(f"{paths['categories']}/names")
    for column, index in fitted.indexes.items():
        save_index(index, f"{paths['categories']}/column={column}")
    fitted.features.write().save(paths["features"])
    fitted.model.write().save(paths["model"])


def load(spark: SparkSession, save_dir: str, name: str) -> Fitted:
    folder = versions.current(spark, _model_dir(save_dir, name))
    if folder is None:
        raise FileNotFoundError(f"no trained {name} model below {save_dir}; train first")
    paths = _paths(folder)
    fill = spark.read.schema("column string, value double").parquet(paths["fill"]).collect()
    names = spark.read.schema("column string").parquet(f"{paths['categories']}/names").collect()
    return Fitted(
        {row["column"]: row["value"] for row in fill},
        PipelineModel.load(paths["features"]),
        choose(name)[2].load(paths["model"]),
        {
            r["column"]: load_index(spark, f"{paths['categories']}/column={r['column']}")
            for r in names
        },
    )


def train(
    df: DataFrame, save_dir: str, name: str = "lr", settings: Settings = Settings(),
    retrain: bool = False,
) -> Fitted:
    """Load what is saved below `save_dir`, or fit and save it."""
    spark = df.sparkSession
    if not retrain and is_saved(spark, save_dir, name):
        return load(spark, save_dir, name)
    fitted = fit(df, name, settings)
    save(spark, fitted, save_dir, name)
    return fitted


def predict(
    df: DataFrame, save_dir: str, name: str = "lr", settings: Settings = Settings()
) -> DataFrame:
    return score(df, load(df.sparkSession, save_dir, name), settings)


def evaluate(
    predictions: DataFrame, name: str, settings: Settings = Settings(),
    metrics_path: str | None = None, run_id: str | None = None,
) -> dict[str, float] | None:
    found = errors(predictions, settings.label, settings.prediction)
    if found is not None and metrics_path is not None:
        log_metrics(predictions.sparkSession, metrics_path, name, found, run_id)
    return found


def run(
    mode: str, train_rows: DataFrame | None, test_rows: DataFrame | None, save_dir: str,
    name: str = "lr", settings: Settings = Settings(), metrics_path: str | None = None,
    retrain: bool = False, run_id: str | None = None,
) -> dict[str, float] | None:
    """`train` fits and saves, `test` predicts and evaluates, `full` does both."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; supported: {', '.join(MODES)}")
    if mode != "test":
        train(train_rows, save_dir, name, settings, retrain)
    if mode == "train":
        return None
    predictions = predict(test_rows, save_dir, name, settings)
    return evaluate(predictions, name, settings, metrics_path, run_id)
