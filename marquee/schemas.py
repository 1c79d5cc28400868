"""Declared schemas. Field names and types are the public data formats and are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Cleaned review: title, 10-point rating, ISO date and release year still as text.
REVIEW = T.StructType(
    _strings("review_id", "movie")
    + [T.StructField("rating", T.DoubleType())]
    + _strings("review_date", "release_time")
)

# Review as it is scraped, before titles and dates are normalised.
RAW_REVIEW = T.StructType(
    _strings(
        "review_id", "reviewer", "movie", "rating", "review_summary", "review_date",
        "review_detail", "helpful",
    )
    + [T.StructField("spoiler_tag", T.IntegerType())]
)

# User review of the site that keeps movies in a table of their own.
SITE_REVIEW = T.StructType(
    _strings("movieId")
    + [T.StructField("rating", T.FloatType())]
    + _strings("reviewId")
    + [T.StructField("isVerified", T.BooleanType()), T.StructField("score", T.DoubleType())]
    + _strings("userDisplayName", "userRealm", "userId")
)
SITE_MOVIE = T.StructType(_strings("movieId", "movieYear", "movieTitle"))

# Product table of the feature-based regression, all text until cast.
PRODUCT = T.StructType(
    _strings(
        "main_category", "title", "average_rating", "rating_number", "price", "store", "parent_asin",
    )
)
PRODUCT_EXCLUDED = (
    "features", "images", "videos", "categories", "bought_together", "description", "details",
)
PRODUCT_NUMERIC = ("price", "rating", "rating_number")

# The one review shape all feeds are mapped onto.
UNIFIED_REVIEW = T.StructType(
    _strings("id", "feed", "reviewId", "userId", "movieId", "movieTitle")
    + [
        T.StructField("movieYear", T.IntegerType()),
        T.StructField("rating", T.FloatType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("review_date", T.DateType()),
        T.StructField("release_time", T.DateType()),
    ]
)

# Columns a message broker delivers.
ENVELOPE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("model", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("mae", T.DoubleType()),
        T.StructField("mse", T.DoubleType()),
    ]
)


def as_text(schema: T.StructType) -> T.StructType:
    """The same fields, all strings: messages are read as text and cast afterwards, because the
    JSON reader turns a quoted number into null when the field is declared numeric."""
    return T.StructType(_strings(*schema.fieldNames()))
