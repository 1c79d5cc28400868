"""Many-to-one joins that hold up when a few keys own most rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.session import materialize

# A dimension is broadcast only if its measured size is at most this many bytes.
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of one key that one task may take; keys with more are split.
PIECE_ROWS = 4_000_000
# Buckets in which rows are counted to find hot keys.
HASH_BUCKETS = 1 << 20


def fits(df: DataFrame, limit: int) -> bool:
    """Whether the rows, uncompressed, take at most `limit` bytes.

    Rows are counted first, which stored tables answer from their footers; the texts are measured
    only where the number of rows leaves the question open.
    """
    per_row = 16 * (len(df.columns) + 1)
    if df.count() * per_row > limit:
        return False
    texts = [size for field in df.schema.fields if (size := _text_size(field)) is not None]
    if not texts:
        return True
    total = sum(texts, F.lit(per_row)).cast("bigint")
    return (df.agg(F.sum(total).alias("bytes")).collect()[0].bytes or 0) <= limit


def _text_size(field: T.StructField) -> Column | None:
    name = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0))
    if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
    return None


def join_many_to_one(
    many: DataFrame,
    one: DataFrame,
    key: str | Sequence[str],
    how: str = "inner",
    *,
    derived: bool = False,
    counts: DataFrame | None = None,
    broadcast_bytes: int | None = None,
    piece_rows: int | None = None,
) -> DataFrame:
    """Join where `key` is unique in `one`; `how` is inner, left or left_semi.

    A measured small side is broadcast. Otherwise both sides are shuffled, and keys with more than
    `piece_rows` rows are cut into pieces: their rows are spread over the pieces and the matching
    row of `one` is repeated once for each.

    `derived` says that `one` is the result of an aggregate or join: it is written once, instead
    of being computed for the measurement and again for the join. `counts` are the rows of `many`
    for each key, or more, in a column `_n`, if they are known; they are counted otherwise.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if derived:
        one = materialize(one, "one")
    if fits(one, BROADCAST_BYTES if broadcast_bytes is None else broadcast_bytes):
        return many.join(F.broadcast(one), keys, how)
    return split_join(many, one, keys, how, piece_rows, counts)


def split_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    how: str,
    piece_rows: int | None = None,
    counts: DataFrame | None = None,
) -> DataFrame:
    """The shuffled form of `join_many_to_one`."""
    piece_rows = piece_rows or PIECE_ROWS
    if counts is None:
        counts = hot_counts(many, keys, piece_rows)
    # At most rows / piece_rows keys can be hot, which bounds the broadcast.
    hot = F.broadcast(
        counts.filter(F.col("_n") > piece_rows).select(
            *keys, F.ceil(F.col("_n") / piece_rows).cast("int").alias("_pieces")
        )
    )
    # The piece depends on the row and its input partition only: a task that is run again puts
    # each row into the same piece, and equal copies in different partitions are spread as well.
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in many.columns], F.spark_partition_id())
    left = many.withColumn("_mark", mark).join(hot, keys, "left")
    # A null key matches nothing, so its rows may go anywhere.
    lost = reduce(or_, [F.col(f"`{k}`").isNull() for k in keys])
    piece = (
        F.when(lost, F.pmod(F.col("_mark"), F.lit(1 << 20)))
        .when(F.col("_pieces").isNull(), 0)
        .otherwise(F.pmod(F.col("_mark"), F.col("_pieces")))
    )
    left = left.withColumn("_piece", piece.cast("int")).drop("_mark", "_pieces")
    right = one.join(hot, keys, "left")
    right = right.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))
    ).drop("_pieces")
    return left.join(right, [*keys, "_piece"], how).drop("_piece")


def hot_counts(many: DataFrame, keys: Sequence[str], piece_rows: int | None = None) -> DataFrame:
    """Counts of the keys that may be hot.

    Rows are counted by hash buckets first, which combines below the shuffle whatever the keys are;
    keys are counted only in buckets with more than `piece_rows` rows, of which there are at most
    rows / piece_rows.
    """
    piece_rows = piece_rows or PIECE_ROWS
    bucket = F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS)).alias("_bucket")
    full = many.groupBy(bucket).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > piece_rows)
    rows = many.select(*keys, bucket).join(F.broadcast(full.select("_bucket")), "_bucket", "left_semi")
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def first_per_key(df: DataFrame, key: str, order: str, columns: Sequence[str]) -> DataFrame:
    """One row for each key: the first by `order`. Combined before the shuffle."""
    row = F.min_by(F.struct(*columns), F.col(order)).alias("_row")
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(row).select(key, "_row.*")


def lookup(
    facts: DataFrame, dimension: DataFrame, key: str, order: str, columns: Sequence[str], **sizes
) -> DataFrame:
    """Add the columns of the first matching dimension row; facts without a match are dropped."""
    one = first_per_key(dimension, key, order, columns)
    return join_many_to_one(facts, one, key, "inner", derived=True, **sizes)
