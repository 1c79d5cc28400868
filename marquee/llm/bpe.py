"""Byte-level BPE by a segment tree over byte positions (operator 11)."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from marquee.llm.columns import without
from marquee.sources.tables import spread

#: A vocabulary file is sent to every executor, so it may have at most this size.
VOCABULARY_BYTES = 64 << 20
#: Pieces of at most PIECE_CHARS characters whose ids are remembered by a worker, at most; when full,
#: it starts again. This changes only time.
REMEMBERED = 1 << 19
PIECE_CHARS = 64
#: Characters of a text that are split into pieces at a time.
CHUNK_CHARS = 1 << 18
#: Bytes of text after which rows are passed on.
BATCH_BYTES = 1 << 21

# Code points that Unicode assigned to letters and numbers after its version 16, which
# is the one that the tokenizer library's patterns know. To them these are neither.
LATER = (
    "0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD-A7E2 A7F1 AB6C-AB6D "
    "107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F "
    "12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3 16FF2-16FF6 187F8-187FF 18CD6-18CDA "
    "18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 "
    "1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED "
    "1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"
)

_NEVER = 1 << 62
# White space after something else always begins a piece, so a text can be cut there.
_CUT = regex.compile(r"(?<=\S)\s")


def _later_class() -> str:
    ends = [part.split("-") for part in LATER.split()]
    return "".join("-".join(f"\\U{int(e, 16):08X}" for e in pair) for pair in ends)


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: of all neighbours the pair of least rank is merged, the leftmost first.

    Leaf i of the tree holds the rank of the pair that begins at byte i, with i in its low bits, so
    the root is the leftmost minimum. A merge ends one pair and gives up to two others new ranks:
    three point updates along logarithmic paths, which stop where nothing changes.
    """
    n = len(piece)
    width = max(n - 2, 0).bit_length()
    size = 1 << width
    rank_of = ranks.get
    tree = [_NEVER] * (2 * size)
    for i, pair in enumerate(zip(piece, piece[1:], strict=False)):
        rank = rank_of(bytes(pair))
        if rank is not None:
            tree[size + i] = rank << width | i
    level = size
    while level > 1:
        tree[level >> 1 : level] = map(min, tree[level : 2 * level : 2], tree[level + 1 : 2 * level : 2])
        level >>= 1
    after = list(range(1, n + 1))
    before = list(range(-1, n))

    best = tree[1]
    while best != _NEVER:
        i = best & (size - 1)
        dead = after[i]
        end = after[dead]
        after[i] = end
        before[end] = i
        # Nodes above i hold its old rank until the last update, so the other paths end there at
        # the latest, or with a lower rank at the root.
        mine = _NEVER
        if end < n:
            value = _NEVER
            node = size + dead
            while tree[node] != value:
                tree[node] = value
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
            rank = rank_of(piece[i : after[end]])
            if rank is not None:
                mine = rank << width | i
        ahead = before[i]
        if ahead >= 0:
            rank = rank_of(piece[ahead:end])
            value = _NEVER if rank is None else rank << width | ahead
            node = size + ahead
            while tree[node] != value:
                tree[node] = value
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
        node = size + i
        while node > 1:
            tree[node] = mine
            other = tree[node ^ 1]
            if other < mine:
                mine = other
            node >>= 1
        tree[1] = best = mine
        tree[0] = _NEVER
    ids, i = [], 0
    while i < n:
        end = after[i]
        ids.append(ranks[piece[i:end]])
        i = end
    return ids


class _Pieces(dict):
    """Little-endian ids of pieces, computed when first asked for."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = [whole] if whole is not None else merge(data, self.ranks)
        packed = pack(f"<{len(ids)}I", *ids)
        if len(piece) <= PIECE_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = packed
        return packed


class Codec:
    """Encodes and decodes by the ranks of a vocabulary file (base64 of a token, its rank).

    A text is split by the pattern; each piece that is a token gets its id, each other one is
    merged by itself. There are no special tokens.
    """

    def __init__(self, vocabulary: bytes, pattern: str):
        lines = (line.split() for line in vocabulary.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        later = _later_class()
        exact = pattern
        for kind in (r"\p{L}", r"\p{N}"):
            exact = exact.replace(kind, f"[{kind}--[{later}]]")
        self._split = regex.compile(pattern)
        self._exact = regex.compile(exact, regex.V1)
        self._later = regex.compile(f"[{later}]")
        self._pieces = _Pieces(self.ranks)

    def encode(self, text: str) -> np.ndarray:
        pattern = self._split if text.isascii() or not self._later.search(text) else self._exact
        found = []
        start = 0
        while start < len(text):
            cut = _CUT.search(text, start + CHUNK_CHARS) if len(text) - start > CHUNK_CHARS else None
            stop = cut.start() if cut else len(text)
            found.append(b"".join(map(self._pieces.__getitem__, pattern.findall(text[start:stop]))))
            start = stop
        return np.frombuffer(b"".join(found), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def read_vocabulary(path: str) -> bytes:
    """A vocabulary file, from a place that the driver can read."""
    size = os.path.getsize(path)
    if size > VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of {size} bytes is too large to be sent to every executor")
    with open(path, "rb") as file:
        return file.read()


_codecs: dict[bytes, Codec] = {}


def shared_codec(vocabulary: bytes, pattern: str) -> Codec:
    """The codec of this worker process; the next tasks find it, and the pieces it remembers."""
    key = blake2b(vocabulary + pattern.encode(), digest_size=16).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(vocabulary, pattern)
    return _codecs[key]


def _replaced(batch: pa.RecordBatch, first: int, last: int, name: str, column: pa.Array) -> pa.RecordBatch:
    rows = batch.slice(first, last - first)
    return pa.RecordBatch.from_arrays([*rows.columns, column], [*rows.schema.names, name])


def _parts(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about BATCH_BYTES."""
    first = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= BATCH_BYTES:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def encoded(batches, codec: Codec, text_column: str, ids_column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.schema.names.index(text_column))
        sizes = pc.binary_length(texts).fill_null(0).to_pylist()
        for first, last in _parts(sizes):
            ids = [codec.encode(text or "") for text in texts.slice(first, last - first).to_pylist()]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            column = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids).view("<i4"), pa.int32()))
            yield _replaced(batch, first, last, ids_column, column)


def decoded(batches, codec: Codec, ids_column: str, bytes_column: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(batch.schema.names.index(ids_column)).fill_null([])
        sizes = pc.multiply(pc.list_value_length(lists), 4).to_pylist()
        for first, last in _parts(sizes):
            rows = [codec.decode(ids.values.to_numpy()) for ids in lists.slice(first, last - first)]
            yield _replaced(batch, first, last, bytes_column, pa.array(rows, pa.binary()))


def _encode(batches, vocabulary, pattern: str, text_column: str, ids_column: str):
    return encoded(batches, shared_codec(vocabulary.value, pattern), text_column, ids_column)


def _decode(batches, vocabulary, pattern: str, ids_column: str, bytes_column: str):
    return decoded(batches, shared_codec(vocabulary.value, pattern), ids_column, bytes_column)


def encode_texts(
    df: DataFrame, path: str, pattern: str, text_column: str = "text", ids_column: str = "token_ids"
) -> DataFrame:
    """All rows with the ids of the tokens of their whole text, as array<int>.

    A null or empty text has no tokens. Repeated rows are rows like others; an empty table gives no
    rows. A column that is named like the new one is replaced, others are kept.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    rows = spread(without(df, [ids_column]))
    schema = T.StructType([*rows.schema.fields, T.StructField(ids_column, T.ArrayType(T.IntegerType()))])
    run = partial(_encode, vocabulary=vocabulary, pattern=pattern, text_column=text_column, ids_column=ids_column)
    return rows.mapInArrow(run, schema)


def decode_ids(
    df: DataFrame, path: str, pattern: str, ids_column: str = "token_ids", bytes_column: str = "decoded"
) -> DataFrame:
    """All rows with the bytes that their ids stand for; null ids stand for none. Ids that the
    vocabulary lacks fail the job."""
    vocabulary = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    rows = without(df, [bytes_column])
    schema = T.StructType([*rows.schema.fields, T.StructField(bytes_column, T.BinaryType())])
    run = partial(_decode, vocabulary=vocabulary, pattern=pattern, ids_column=ids_column, bytes_column=bytes_column)
    return rows.mapInArrow(run, schema)
