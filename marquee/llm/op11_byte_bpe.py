"""Query of operator 11."""

from __future__ import annotations

from functools import partial
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marquee.llm.bpe import decoded, encode_texts, read_vocabulary, shared_codec
from marquee.llm.plans import query, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _digests(batches, vocabulary):
    """The ids decoded, and digests of both."""
    codec = shared_codec(vocabulary.value, public_tokenizers.PATTERN)
    for batch in decoded(batches, codec, "token_ids", "decoded"):
        column = dict(zip(batch.schema.names, batch.columns, strict=True))
        ends = np.asarray(column["token_ids"].offsets)
        values = np.asarray(column["token_ids"].values).astype("<u4")
        found = {
            "doc_id": column["doc_id"],
            "n_tokens": pa.array(np.diff(ends), pa.int64()),
            "ids_sha256": pa.array([sha256(values[a:b]).hexdigest() for a, b in zip(ends, ends[1:], strict=False)]),
            "decoded_sha256": pa.array([sha256(text.as_buffer()).hexdigest() for text in column["decoded"]]),
        }
        yield pa.RecordBatch.from_pydict(found)


@query("op11_byte_bpe")
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again; digests of ids and bytes."""
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_texts(docs, path, public_tokenizers.PATTERN).select("doc_id", "token_ids")
    vocabulary = spark.sparkContext.broadcast(read_vocabulary(path))
    return encoded.mapInArrow(
        partial(_digests, vocabulary=vocabulary),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
