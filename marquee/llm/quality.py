"""Quality classifier by co-training on two views (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.columns import without
from marquee.llm.store import Store
from marquee.llm.words import Words, words_of
from marquee.operators.ordering import value_at_rank
from marquee.sources.tables import spread

#: Documents with a label that the views are fitted on, at most: those with the smallest hash of
#: their id.
LABELLED = 16384
#: Rounds of exchange; pseudo-labels of each class that a view gives the other in one of them, the
#: ones it is surest of among all documents without a label, and how sure it must be.
ROUNDS = 3
GIVEN = 1024
SURE = 0.95
#: One of so many labelled documents is held out to calibrate the views.
FOLDS = 5

WORD_BUCKETS = 1 << 15
META_BUCKETS = 1 << 8
CONTENT_STATS = 6
META_STATS = 5

_SYMBOL = np.zeros(256, np.int32)
_SYMBOL[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 1
_UPPER = np.zeros(256, np.int32)
_UPPER[65:91] = 1
_BAR = np.zeros(256, np.int32)
_BAR[ord("|")] = 1
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


def _share(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, by: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(table[data], dtype=np.int64)))
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(by, 1)


def content_features(words: Words) -> tuple[list[np.ndarray], np.ndarray]:
    """For each row the buckets of its distinct words, and numbers about its words and signs."""
    count = np.diff(words.ptr)
    size = np.diff(words.offsets)
    buckets, distinct = [], np.zeros(len(words))
    all_buckets = (words.hashes % np.uint64(WORD_BUCKETS)).astype(np.int32)
    for i in range(len(words)):
        own = np.sort(all_buckets[words.ptr[i] : words.ptr[i + 1]])
        if len(own):
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        buckets.append(own)
        distinct[i] = len(own)
    same = np.concatenate(([0], np.cumsum(words.hashes[1:] == words.hashes[:-1]), [0])).astype(np.int64)
    first, last = words.ptr[:-1], np.maximum(words.ptr[1:] - 1, words.ptr[:-1])
    again = np.where(count > 1, same[np.minimum(last, len(same) - 1)] - same[np.minimum(first, len(same) - 1)], 0)
    stats = np.stack([
        again / np.maximum(count, 1),
        distinct / np.maximum(count, 1),
        _share(words.data, words.offsets, _SYMBOL, count),
        _share(words.data, words.offsets, _UPPER, size),
        _share(words.data, words.offsets, _BAR, count),
        size / np.maximum(count, 1) / 10,
    ], axis=1)
    return buckets, stats


def page_features(words: Words, batch: pa.RecordBatch, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each row the buckets of its metadata, and numbers about its layout."""
    rows = batch.slice(words.first, len(words))
    buckets = np.zeros((len(words), len(columns)), np.int32)
    for k, name in enumerate(columns):
        for i, value in enumerate(rows.column(rows.schema.names.index(name)).to_pylist()):
            buckets[i, k] = crc32(f"{k}={value}".encode()) % META_BUCKETS
    size = np.diff(words.offsets)
    newline = np.flatnonzero(words.data == 10)
    lines = np.searchsorted(newline, words.offsets[1:]) - np.searchsorted(newline, words.offsets[:-1]) + 1
    stops = np.zeros(256, np.int32)
    stops[_STOP] = 1
    ends = np.zeros(len(words.data), np.int32)
    ends[newline[newline > 0]] = stops[words.data[newline[newline > 0] - 1]]
    ended = np.concatenate(([0], np.cumsum(ends, dtype=np.int64)))
    closed = ended[words.offsets[1:]] - ended[words.offsets[:-1]]
    stats = np.stack([
        np.log1p(size), np.log1p(lines), np.log1p(size / lines), closed / lines,
        np.diff(words.ptr) / np.maximum(size, 1),
    ], axis=1)
    return buckets, stats


def _chunks(batch: pa.RecordBatch, text_column: str) -> Iterator[Words]:
    yield from words_of(batch.column(batch.schema.names.index(text_column)))


FEATURES = "doc_id long, words array<int>, content array<double>, pages array<int>, layout array<double>"


def _featured(batches, columns: Sequence[str]):
    """Features of every document, in lists, for fitting and for the rounds of exchange."""
    names = ["doc_id", "words", "content", "pages", "layout"]
    for batch in batches:
        for words in _chunks(batch, "text"):
            rows = batch.slice(words.first, len(words))
            buckets, stats = content_features(words)
            pages, layout = page_features(words, batch, columns)
            pages = [np.unique(own) for own in pages]
            lists = [_lists(buckets), _matrix(stats), _lists(pages), _matrix(layout)]
            yield pa.RecordBatch.from_arrays([rows.column(rows.schema.names.index("doc_id")), *lists], names)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0)
    return pa.ListArray.from_arrays(ends, pa.array(flat.astype(np.int32), pa.int32()))


def _matrix(rows: np.ndarray) -> pa.Array:
    ends = np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.ravel(rows), pa.float64()))


def _sums(lists: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The weights of each row's buckets, added up."""
    ends = np.asarray(lists.offsets)
    upto = np.concatenate(([0.0], np.cumsum(weights[np.asarray(lists.values)])))
    return upto[ends[1:]] - upto[ends[:-1]]


def _raw(view: View, lists: pa.Array, stats: pa.Array, width: int) -> np.ndarray:
    flat = np.asarray(stats.values)[stats.offsets[0].as_py() :].reshape(len(stats), -1)
    return _sums(lists, view.weights[:width]) + flat @ view.weights[width:] + view.intercept


def _told(batches, content: View, pages: View):
    """(doc_id, a, b): the probability of each view, before calibration."""
    for batch in batches:
        column = dict(zip(batch.schema.names, batch.columns, strict=True))
        a = _raw(content, column["words"], column["content"], WORD_BUCKETS)
        b = _raw(pages, column["pages"], column["layout"], META_BUCKETS)
        yield pa.RecordBatch.from_pydict({"doc_id": column["doc_id"], "a": _sigmoid(a), "b": _sigmoid(b)})


def _vector(buckets: str, stats: str, width: int, numbers: int) -> Column:
    """The stored form of a sparse vector: ones at the buckets, then the numbers."""
    behind = F.array(*[F.lit(width + i) for i in range(numbers)])
    ones = F.transform(buckets, lambda _: F.lit(1.0))
    return F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(width + numbers).alias("size"),
        F.concat(buckets, behind).alias("indices"),
        F.concat(ones, stats).alias("values"),
    )


@dataclass
class View:
    """A linear view and its calibration; the logit is scale * (weights x + intercept) + shift."""

    weights: np.ndarray
    intercept: float
    scale: float = 1.0
    shift: float = 0.0

    def logits(self, raw: np.ndarray) -> np.ndarray:
        return self.scale * raw + self.shift


@dataclass
class Model:
    """Both views, and the weights of their calibrated logits in the joint score."""

    content: View
    pages: View
    joint: np.ndarray
    columns: tuple[str, ...]

    def score(self, words: Words, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        buckets, stats = content_features(words)
        weights = self.content.weights[:WORD_BUCKETS]
        raw = np.array([weights[own].sum() for own in buckets]) if buckets else np.zeros(0)
        raw = raw + stats @ self.content.weights[WORD_BUCKETS:] + self.content.intercept
        a = self.content.logits(raw)
        pages, layout = page_features(words, batch, self.columns)
        weights = self.pages.weights[:META_BUCKETS]
        raw = np.array([weights[sorted(set(own))].sum() for own in pages.tolist()]) if len(pages) else np.zeros(0)
        b = self.pages.logits(raw + layout @ self.pages.weights[META_BUCKETS:] + self.pages.intercept)
        return _sigmoid(a), _sigmoid(b), _sigmoid(self.joint[0] + self.joint[1] * a + self.joint[2] * b)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, center: Sequence[float], rows: float = 4.0) -> np.ndarray:
    """Intercept and weights for a few columns of the held-out fold, by Newton's method.

    They are drawn towards `center` as by so many rows, so that a few held-out labels cannot turn a
    view around.
    """
    x = np.column_stack([np.ones(len(x)), x])
    center = np.asarray(center, dtype=float)
    w = center.copy()
    penalty = rows * np.eye(x.shape[1])
    for _ in range(50):
        p = _sigmoid(x @ w)
        slope = (x * (p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(slope, x.T @ (y - p) - penalty @ (w - center))
        w = w + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, bad): 1 if any row calls the document poor (quality 0) or toxic, else 0. Rows
    without an id, or without both marks, say nothing."""
    bad = F.greatest(1 - F.col("quality").cast("int"), F.col("toxic").cast("int"))
    return (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(bad).cast("double").alias("bad"))
        .where("bad is not null")
    )


def _chosen(taught: DataFrame, count: int) -> DataFrame:
    """At most `count` rows of distinct ids, those with the smallest hash."""
    if taught.count() <= count:
        return taught
    hashed = taught.withColumn("h", F.xxhash64("doc_id", F.lit("chosen")))
    return hashed.where(F.col("h") <= value_at_rank(hashed, "h", count)).drop("h")


def _once(features: DataFrame, ids: DataFrame) -> DataFrame:
    """The features of some documents, few enough to be sent about; of a repeated id one row's."""
    rows = features.join(F.broadcast(ids), "doc_id")
    lists = F.struct("words", "content", "pages", "layout")
    once = rows.groupBy("doc_id", "bad").agg(F.min(lists).alias("f"))
    return once.select("doc_id", "bad", "f.*")


def train(
    documents: DataFrame,
    labels: DataFrame,
    store: Store,
    id_column: str = "doc_id",
    text_column: str = "text",
    metadata: Sequence[str] = ("source", "lang"),
    labelled: int = LABELLED,
) -> Model | None:
    """Fit both views by co-training; None if no document has a label.

    The content view sees words, repetition and signs; the page view sees metadata and layout. In
    each round a view labels the documents that it is surest of, among all without a label, for the
    other one. Both are then calibrated, and their logits weighted, on the labelled documents that
    were held out.

    The features of all documents are written once, in about a quarter of the texts' bytes; the
    rounds read those. Of a round only ids and probabilities of which a view is sure are shuffled.
    """
    known = store.keep(known_labels(labels), "known")
    names = tuple(f"meta{i}" for i in range(len(metadata)))
    texts = documents.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        F.col(f"`{text_column}`").alias("text"),
        *[F.col(f"`{c}`").cast("string").alias(n) for c, n in zip(metadata, names, strict=True)],
    ).where("doc_id is not null")
    features = store.keep(spread(texts).mapInArrow(partial(_featured, columns=names), FEATURES), "features")
    taught = _chosen(known.join(features.select("doc_id").distinct(), "doc_id", "left_semi"), labelled)
    # at most `labelled` rows of 16 bytes
    rows = _fold(_once(features, store.keep(taught, "chosen")))
    rows = store.keep(rows, "rows", FOLDED).coalesce(8)
    train_rows = rows.where("bad is not null and not held")
    if train_rows.isEmpty():
        train_rows = rows.where("bad is not null")
    if train_rows.isEmpty():
        return None
    learn_a = train_rows.select("a", "bad")
    learn_b = train_rows.select("b", "bad")
    for turn in range(ROUNDS + 1):
        view_a = _fit(learn_a, "a", 1.0, 0.001)
        view_b = _fit(learn_b, "b", 0.0, 0.01)
        if turn == ROUNDS:
            break
        told = features.mapInArrow(partial(_told, content=_view(view_a), pages=_view(view_b)), "doc_id long, a double, b double")
        sure = [(F.col(c) >= SURE) | (F.col(c) <= 1 - SURE) for c in "ab"]
        told = told.where(sure[0] | sure[1]).join(known, "doc_id", "left_anti")
        told = store.keep(told.groupBy("doc_id").agg(F.max("a").alias("a"), F.max("b").alias("b")), "told")
        given_b = store.keep(_fold(_once(features, _sure(told, "a"))), "given", FOLDED).coalesce(8)
        given_a = store.keep(_fold(_once(features, _sure(told, "b"))), "given", FOLDED).coalesce(8)
        learn_a = train_rows.select("a", "bad").unionByName(given_a.select("a", "bad"))
        learn_b = train_rows.select("b", "bad").unionByName(given_b.select("b", "bad"))
    held = rows.where("bad is not null and held").select("a", "b", "bad")
    for view in (view_a, view_b):
        column = view.getFeaturesCol()
        held = view.setPredictionCol("").setProbabilityCol("").setRawPredictionCol(f"raw_{column}").transform(held)
    found = held.select("bad", *[vector_to_array(f"raw_{c}")[1].alias(c) for c in "ab"]).toPandas()
    found = found.replace([np.inf, -np.inf], np.nan).dropna()
    views = [_view(v) for v in (view_a, view_b)]
    y = found["bad"].to_numpy()
    joint = np.array([0.0, 0.5, 0.5])
    if len(set(y)) > 1:
        for view, column in zip(views, "ab", strict=True):
            view.shift, view.scale = fit_logistic(found[[column]].to_numpy(), y, (0, 1))
        both = np.column_stack([v.logits(found[c].to_numpy()) for v, c in zip(views, "ab", strict=True)])
        joint = fit_logistic(both, y, joint)
    return Model(*views, joint, tuple(metadata))


def _fit(rows: DataFrame, column: str, lasso: float, penalty: float):
    return LogisticRegression(
        featuresCol=column, labelCol="bad", family="binomial", maxIter=30, regParam=penalty, elasticNetParam=lasso
    ).fit(rows)


def _view(fitted) -> View:
    return View(np.asarray(fitted.coefficients.toArray()), float(np.clip(fitted.intercept, -20, 20)))


#: What `_fold` has written, with the vectors as such.
FOLDED = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("bad", T.DoubleType()), T.StructField("a", VectorUDT()),
    T.StructField("b", VectorUDT()), T.StructField("held", T.BooleanType()),
])


def _fold(rows: DataFrame) -> DataFrame:
    """(doc_id, bad, a, b, held): the vectors of both views, and whether a row is held out."""
    return rows.select(
        "doc_id",
        "bad",
        _vector("words", "content", WORD_BUCKETS, CONTENT_STATS).alias("a"),
        _vector("pages", "layout", META_BUCKETS, META_STATS).alias("b"),
        (F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)) == 0).alias("held"),
    )


def _sure(told: DataFrame, view: str) -> DataFrame:
    """(doc_id, bad): what a view is surest of, at most GIVEN of each class."""
    p = F.col(view)
    bad = told.where(p >= SURE).orderBy(p.desc(), "doc_id").limit(GIVEN)
    good = told.where(p <= 1 - SURE).orderBy(p, "doc_id").limit(GIVEN)
    bad, good = (rows.select("doc_id", F.lit(y).alias("bad")) for rows, y in ((bad, 1.0), (good, 0.0)))
    return bad.unionByName(good)


SCORES = ("p_content", "p_pages", "p_bad")


def _scored(batches, model: Model | None, text_column: str):
    for batch in batches:
        for words in _chunks(batch, text_column):
            rows = batch.slice(words.first, len(words))
            if model is None:
                scores = [np.zeros(len(words))] * len(SCORES)
            else:
                scores = model.score(words, batch)
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *[pa.array(s, pa.float64()) for s in scores]], [*rows.schema.names, *SCORES]
            )


def score_documents(
    documents: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    metadata: Sequence[str] = ("source", "lang"),
) -> DataFrame:
    """All rows with p_content, p_pages and p_bad, the probabilities that a document is poor or
    toxic by its content, by its page, and by both.

    The views are fitted on a bounded choice of labelled documents (LABELLED) and on those that they
    label for each other, chosen from all documents; every document is scored on its whole text. Null and empty texts are
    scored by the intercepts and their metadata; a null metadata value is a value like others. Rows
    without an id are scored but not learnt from, a repeated id is learnt from once. Without any
    label all probabilities are 0. Columns named like the three scores are replaced, others are
    kept. An empty table gives no rows.
    """
    store = Store(documents.sparkSession, "quality")
    rows = without(documents, SCORES)
    model = train(rows, labels, store, id_column, text_column, metadata)
    schema = T.StructType([*rows.schema.fields, *[T.StructField(s, T.DoubleType()) for s in SCORES]])
    return rows.mapInArrow(partial(_scored, model=model, text_column=text_column), schema)


def rejected(limit: float = 0.5) -> Column:
    return F.col("p_bad") >= limit
