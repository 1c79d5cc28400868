"""Words of texts as arrays of 64-bit hashes, without a Python object for each word.

A word is a run of bytes other than space and tab to carriage return; A-Z are lower-cased. These
bytes never occur inside a UTF-8 sequence, so the bytes can be cut as they are. A hash mixes eight
bytes at a time and the length; two words of one text would collide once in about 10^19 pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Bytes of text that are taken apart at a time; one longer text is a chunk of its own.
CHUNK_BYTES = 1 << 21
#: Longer words are hashed one by one.
LONG_WORD = 256

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_TAIL = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose results look random."""
    x = x + _STEP
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """The words of rows `first` and following: row i has `hashes[ptr[i]:ptr[i + 1]]`.

    `starts` and `ends` are byte positions in `data`, in which row i begins at `offsets[i]`.
    """

    first: int
    ptr: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.ptr) - 1


def words_of(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    """Chunks of consecutive rows. A null text has no words."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + chunk_bytes, "right")) - 1
        last = max(last, first + 1)
        part = offsets[first : last + 1] - offsets[first]
        yield _cut(first, part, data[offsets[first] : offsets[last]])
        first = last


def _cut(first: int, offsets: np.ndarray, data: np.ndarray) -> Words:
    lower = np.zeros(len(data) + 8, np.uint8)
    lower[: len(data)] = _LOWER[data]
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IS_WORD[data]
    begins = inside[1:-1] & ~inside[:-2]
    at = offsets[:-1][offsets[:-1] < len(data)]
    begins[at] = inside[1:-1][at]
    stops = inside[1:-1] & ~inside[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner <= len(data))] - 1
    stops[inner] = inside[1:-1][inner]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    ptr = np.searchsorted(starts, offsets)
    return Words(first, ptr, _hashes(lower, starts, ends), starts, ends, data, offsets)


def _hashes(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    eights = np.ndarray((len(lower) - 7,), "<u8", lower.data, 0, (1,))
    out = lengths.astype(np.uint64)
    left = np.flatnonzero(lengths <= LONG_WORD)
    done = 0
    while len(left):
        size = lengths[left] - done
        out[left] = mix(out[left] ^ (eights[starts[left] + done] & _TAIL[np.minimum(size, 8)]))
        left = left[size > 8]
        done += 8
    for i in np.flatnonzero(lengths > LONG_WORD):
        digest = hashlib.blake2b(lower[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = np.frombuffer(digest, "<u8")[0]
    return out


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words, by position; with fewer words, of the whole run."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    count = len(hashes) - width + 1
    out = np.full(count, width, np.uint64)
    for k in range(width):
        out = mix(out ^ hashes[k : k + count])
    return out
