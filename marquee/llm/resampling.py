"""Importance resampling towards a target distribution of hashed n-grams (operator 12)."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.columns import without
from marquee.llm.store import Store
from marquee.operators.ordering import value_at_rank, with_rank
from marquee.sources.tables import spread

#: Buckets of features. Their counts go to the driver and to every executor, so this bounds both.
BUCKETS = 10_000
#: Words of a text whose features are hashed at a time.
CHUNK_WORDS = 1 << 16
#: The two words before a chunk, whose runs go on in it.
LONGEST = 3

_WORD = b"0123456789abcdefghijklmnopqrstuvwxyz"
#: A-Z become a-z; ASCII other than letters and digits becomes a space. UTF-8 sequences stay.
TABLE = bytes(b if b >= 128 or b in _WORD else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


def features(words: list[bytes]) -> list[int]:
    """Unsigned crc32 of all runs of one to three words, joined by a space.

    A run's checksum seeds that of the run with one more word, so no run is put together.
    """
    spaced = [b" " + word for word in words[1:]]
    ones = list(map(crc32, words))
    twos = list(map(crc32, spaced, ones))
    threes = list(map(crc32, spaced[1:], twos))
    return ones + twos + threes


def _chunks(words: list[bytes]) -> Iterator[list[int]]:
    """The features of a text, a bounded number at a time: those that begin in each chunk."""
    for start in range(0, len(words), CHUNK_WORDS):
        part = words[start : start + CHUNK_WORDS + LONGEST - 1]
        found = features(part)
        extra = len(part) - CHUNK_WORDS
        if extra > 0:  # runs that lie behind the chunk belong to the next one
            n = len(part)
            ones, twos, threes = found[:n], found[n : 2 * n - 1], found[2 * n - 1 :]
            found = ones[:CHUNK_WORDS] + twos[:CHUNK_WORDS] + threes
        yield found


def _buckets(found: list[int], buckets: int) -> np.ndarray:
    return np.array(found, np.uint32) % np.uint32(buckets)


def _counted(batches, buckets: int) -> Iterator[pa.RecordBatch]:
    """One row for each bucket that a task has met."""
    counts: Counter[int] = Counter()
    for batch in batches:
        for text in batch.column(0).cast(pa.large_binary()):
            for found in _chunks(words_of(text.as_py() or b"")):
                counts.update(_buckets(found, buckets).tolist())
    if counts:
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(counts.keys(), pa.int32()), "n": pa.array(counts.values(), pa.int64())}
        )


def bucket_counts(df: DataFrame, text_column: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over the features of all texts: counters of tasks, added up."""
    texts = df.select(F.col(f"`{text_column}`").cast("string").alias("text"))
    counted = spread(texts).mapInArrow(partial(_counted, buckets=buckets), "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


@dataclass
class Gains:
    """What a feature of each bucket adds to a document's weight."""

    by_bucket: np.ndarray

    @classmethod
    def of(cls, target: dict[int, int], source: dict[int, int], buckets: int = BUCKETS) -> Gains:
        """floor(1000 ln(share in the target / share in the source)), shares smoothed by one."""
        all_target, all_source = float(sum(target.values())), float(sum(source.values()))
        ratio = [
            (target.get(b, 0) + 1.0) * (all_source + buckets) / ((source.get(b, 0) + 1.0) * (all_target + buckets))
            for b in range(buckets)
        ]
        return cls(np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64))

    def weigh(self, text: bytes) -> tuple[int, int, int]:
        """Words, features and weight of a text."""
        words = words_of(text)
        n = weight = 0
        for found in _chunks(words):
            n += len(found)
            weight += int(self.by_bucket[_buckets(found, len(self.by_bucket))].sum())
        return len(words), n, weight


def fit_gains(
    documents: DataFrame, target: DataFrame, text_column: str = "text", buckets: int = BUCKETS
) -> Gains:
    """Gains from all documents and all target texts. At most `buckets` rows of each come here."""
    source, wanted = (
        {row.bucket: row.n for row in bucket_counts(df, text_column, buckets).collect()}
        for df in (documents, target)
    )
    return Gains.of(wanted, source, buckets)


def noise(seed: int, doc_id: int | None) -> int:
    """A draw that is fixed by the id: floor(-1000 ln(-ln u)) for a u from its digest."""
    h = int(sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighed(batches, gains, seed: int, id_column: str, text_column: str, carry: list[str]):
    names = ["row", *NUMBERS]
    for batch in batches:
        column = dict(zip(batch.schema.names, batch.columns, strict=True))
        ids = column[id_column].to_pylist()
        texts = column[text_column].cast(pa.large_binary())
        found = [(*gains.value.weigh(text.as_py() or b""), noise(seed, i)) for text, i in zip(texts, ids, strict=True)]
        words, n, weight, drawn = np.array(found, np.int64).reshape(-1, 4).T
        row = pa.StructArray.from_arrays([column[c] for c in carry], carry)
        yield pa.RecordBatch.from_arrays([row, *map(pa.array, (words, n, weight, weight + drawn))], names)


NUMBERS = ("n_words", "n_features", "weight", "score")


def resample(
    documents: DataFrame,
    target: DataFrame,
    share: tuple[int, int] = (5, 100),
    least_words: int = 20,
    seed: int = 42,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: Sequence[str] | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """All rows with n_words, n_features, weight, score and rank (all long).

    `weight` is the log ratio of the target's to the documents' bag of hashed n-grams, `score` adds
    a Gumbel draw that the id fixes, and of the N rows with at least `least_words` words the
    floor(share N) best get a rank from 1, which draws them without replacement in proportion to
    their ratio; the others' rank is null. Ties go to the smaller id, a null id first; rows that
    are equal in both are ranked in any order.

    A null or empty text has no features and weight 0. Repeated rows count and are drawn like
    others. An empty table gives no rows; an empty target makes all buckets equally likely there.
    `carry` names the columns that stay, all by default; columns named like the new ones are
    replaced.

    The weighed rows are written once. The last score that is drawn is found by counting in ranges,
    so that only the drawn rows, and ties with the last, are put in order.
    """
    spark = documents.sparkSession
    store = Store(spark, "resampling")
    rows = without(documents, [*NUMBERS, "rank"])
    stay = list(rows.columns if carry is None else carry)
    if id_column not in stay:
        raise ValueError("the id must stay, because ties go by it")
    gains = spark.sparkContext.broadcast(fit_gains(rows, target, text_column, buckets))
    read = rows.select(*[f"`{name}`" for name in dict.fromkeys([id_column, text_column, *stay])])
    whole = T.StructType([rows.schema[name] for name in stay])
    schema = T.StructType([T.StructField("row", whole), *[T.StructField(n, T.LongType()) for n in NUMBERS]])
    run = partial(_weighed, gains=gains, seed=seed, id_column=id_column, text_column=text_column, carry=stay)
    weighed = store.keep(spread(read).mapInArrow(run, schema), "weighed")
    drawable = F.col("n_words") >= least_words
    take = weighed.where(drawable).count() * share[0] // share[1]
    last = -value_at_rank(weighed.where(drawable).select((-F.col("score")).alias("s")), "s", take) if take else None
    near = F.lit(False) if last is None else drawable & (F.col("score") >= last)
    order = [F.desc("score"), F.asc_nulls_first(f"row.`{id_column}`")]
    ranked = with_rank(weighed.where(near), order).withColumn(
        "rank", F.when(F.col("rank") <= take, F.col("rank").cast("long"))
    )
    others = weighed.where(~near).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select("row.*", *NUMBERS, "rank")
