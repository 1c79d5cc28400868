"""Term statistics with readable terms instead of hash buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import byte_length, words
from marquee.operators.joins import join_many_to_one
from marquee.session import materialize

# Bytes of the texts whose words one task counts: its counters take tens of times that.
TASK_BYTES = 8 << 20


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf): how often each word occurs in each text."""
    # The texts are hashed by key before they are cut, which is less to move than their words; the
    # counts then need no other exchange. The number of parts follows the bytes, so that a task's
    # counters do not grow with the input.
    size = df.agg(F.sum(byte_length(F.col(text)))).first()[0] or 0
    parts = max(size // TASK_BYTES + 1, df.sparkSession.sparkContext.defaultParallelism)
    texts = df.select(key, text).repartition(parts, key)
    terms = texts.select(key, F.explode(words(F.col(text))).alias("term"))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def tf_idf(df: DataFrame, key: str, text: str, **sizes) -> DataFrame:
    """(key, term, tf, df, tfidf) with idf = ln((texts + 1) / (texts with the term + 1)).

    `key` must be unique. The texts are split into words once; the counts are written and read
    for both sides of the join. Common terms are in most texts, so that join is the one that splits
    frequent keys.
    """
    texts = df.count()
    tf = materialize(term_counts(df, key, text), "terms")
    seen = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "seen")
    known = seen.withColumnRenamed("df", "_n")
    joined = join_many_to_one(tf, seen, "term", "inner", counts=known, **sizes)
    idf = F.log((F.lit(texts) + 1.0) / (F.col("df") + 1.0))
    return joined.select(key, "term", "tf", "df", (F.col("tf") * idf).alias("tfidf"))
