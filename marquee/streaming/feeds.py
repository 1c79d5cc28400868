"""The three review feeds: payload schema, required field, projection onto the unified review.

The same functions work on static frames and on streams.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import records, values
from marquee.schemas import RAW_REVIEW, REVIEW, UNIFIED_REVIEW, as_text
from marquee.sources.sinks import conform

# Fields of the enriched review message; its year is text that may read `2019.0`.
ENRICHED_REVIEW = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in ("movieId", "rating", "reviewId", "score", "userId", "movieYear", "movieTitle")
    ]
)


def _clean_review() -> dict[str, Column]:
    return {
        "reviewId": values.present(F.col("review_id")),
        "movieTitle": values.present(F.col("movie")),
        "rating": values.to_float(F.col("rating")),
        "review_date": values.iso_date(F.col("review_date")),
        "release_time": values.year_start(F.col("release_time")),
    }


def _raw_review() -> dict[str, Column]:
    """A raw review scores out of 10 and has no movie id or year of its own."""
    return {
        "reviewId": values.present(F.col("review_id")),
        "userId": values.present(F.col("reviewer")),
        "movieTitle": values.present(F.col("movie")),
        "rating": values.half_scale(F.col("rating")),
        "score": values.to_float(F.col("rating")),
        "movieId": F.lit(None).cast("string"),
        "movieYear": F.lit(None).cast("int"),
    }


def _site_review() -> dict[str, Column]:
    return {
        "reviewId": values.present(F.col("reviewId")),
        "userId": values.present(F.col("userId")),
        "movieId": values.present(F.col("movieId")),
        "movieTitle": values.present(F.col("movieTitle")),
        "movieYear": values.to_int(F.col("movieYear")),
        "rating": values.to_float(F.col("rating")),
        "score": values.to_double(F.col("score")),
    }


@dataclass(frozen=True)
class Feed:
    payload: T.StructType
    required: str
    columns: Callable[[], dict[str, Column]]


# The topic names.
FEEDS = {
    "imdb": Feed(as_text(REVIEW), "review_id", _clean_review),
    "mubi-sqlite": Feed(as_text(RAW_REVIEW), "review_id", _raw_review),
    "rotten-tomatoes": Feed(ENRICHED_REVIEW, "reviewId", _site_review),
}


def unify(df: DataFrame, topic: str, row_id: Column) -> DataFrame:
    """Parsed rows of one feed as unified reviews."""
    columns = [column.alias(name) for name, column in FEEDS[topic].columns().items()]
    shaped = df.select(row_id.alias("id"), F.lit(topic).alias("feed"), *columns, *version(df))
    return conform(shaped, with_version(df))


def version(df: DataFrame) -> list[Column]:
    """Where the row came from, if it came as a message: the later one wins on equal ids."""
    names = [name for name in ("timestamp", "partition", "offset") if name in df.columns]
    return [F.col(name).alias(f"_{name}") for name in names]


def with_version(df: DataFrame) -> T.StructType:
    names = [name for name in ("timestamp", "partition", "offset") if name in df.columns]
    return T.StructType(
        UNIFIED_REVIEW.fields + [T.StructField(f"_{n}", df.schema[n].dataType) for n in names]
    )


def parse(messages: DataFrame, topic: str, row_id: Column | None = None) -> DataFrame:
    """Messages of one topic as unified reviews; those that cannot be decoded are skipped.

    Without `row_id`, a message is identified by its place in the topic.
    """
    feed = FEEDS[topic]
    place = [c for c in ("topic", "partition", "offset", "timestamp") if c in messages.columns]
    rows = records.payload_rows(
        messages.select("value", *place), feed.payload, feed.required, "value"
    )
    if row_id is None:
        row_id = values.stable_id(F.col("topic"), F.col("partition"), F.col("offset"))
    return unify(rows, topic, row_id)
