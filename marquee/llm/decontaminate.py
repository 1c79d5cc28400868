"""Benchmark decontamination by n-gram seeds and local alignment (operator 9)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.columns import without
from marquee.llm.words import Words, mix, shingles, words_of

#: Words of a seed; the one of an item with fewer words is the whole item.
WIDTH = 3
#: Alignment: points for equal words, and off for others and for gaps.
MATCH, MISMATCH, GAP = 2, 1, 1
#: Share of the points of a whole copy from which on a passage is one.
LIMIT = 0.5
#: Items with fewer words must occur word by word.
SHORT = 8
#: Bytes of benchmark text that are searched for at a time; more are taken in several blocks.
BLOCK_BYTES = 16 << 20
#: An n-gram that more items than these have is a phrase of its kind, and seeds none of them.
SHARED = 32
#: Of the n-grams of an item that occur in the documents so many seed it at least, the rarest first,
#: and so large a part of them.
SEEDS, PART = 12, 7 / 8
#: Hits of seeds that are sorted at a time; a row with more is taken by itself.
HITS = 1 << 21

_TABLE_BITS = 20

FOUND = T.ArrayType(
    T.StructType([
        T.StructField("item_id", T.LongType()), T.StructField("score", T.LongType()),
        T.StructField("ratio", T.DoubleType()), T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
    ])
)
_FOUND = pa.list_(
    pa.struct([
        ("item_id", pa.int64()), ("score", pa.int64()), ("ratio", pa.float64()),
        ("first_word", pa.int64()), ("last_word", pa.int64()),
    ])
)


@dataclass
class Grams:
    """Sorted n-grams with a table that rules out most others at once."""

    values: np.ndarray
    table: np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> Grams:
        values = np.unique(values)
        table = np.zeros(1 << _TABLE_BITS, bool)
        table[values & np.uint64((1 << _TABLE_BITS) - 1)] = True
        return cls(values, table)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in `grams` of those that are here, and their places here."""
        at = np.flatnonzero(self.table[grams & np.uint64((1 << _TABLE_BITS) - 1)])
        if not len(at) or not len(self.values):
            return at[:0], at[:0]
        place = np.searchsorted(self.values, grams[at])
        place[place == len(self.values)] = 0
        same = self.values[place] == grams[at]
        return at[same], place[same]


@dataclass
class Items:
    """The items of a block, equal ones as one: their ids and words, and the seeds with the items
    that have them."""

    ids: list[list[int]]
    words: list[np.ndarray]
    widths: list[int]
    seeds: Grams
    first: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, ids: list[int], words: list[np.ndarray]) -> Items:
        """Every n-gram of an item is a seed; `rare` leaves the rare ones."""
        same: dict[bytes, list[int]] = {}
        for i, own in enumerate(words):
            same.setdefault(own.tobytes(), []).append(i)
        groups = list(same.values())
        own_words = [words[group[0]] for group in groups]
        pairs = {(int(g), i) for i, own in enumerate(own_words) for g in shingles(own, WIDTH)}
        return cls._of([[ids[i] for i in group] for group in groups], own_words, pairs)

    @classmethod
    def _of(cls, ids: list[list[int]], words: list[np.ndarray], pairs: set[tuple[int, int]]) -> Items:
        ordered = sorted(pairs)
        grams = np.array([g for g, _ in ordered], np.uint64)
        seeds = Grams.of(grams)
        first = np.append(np.searchsorted(grams, seeds.values), len(ordered))
        widths = sorted({min(WIDTH, len(own)) for own in words})
        return cls(ids, words, widths, seeds, first, np.array([i for _, i in ordered], np.int64))

    def rare(self, counts: np.ndarray) -> Items:
        """The same items with fewer seeds; `counts` says how often each seed occurs in the documents.

        An n-gram that does not occur can find nothing. One that over SHARED items have would bring
        each document with the phrase together with all of them; only an item that has no other
        n-gram is looked for by those. Of what is left the rarest are taken.
        """
        owners = np.diff(self.first)
        mine: dict[int, list[tuple[bool, int, int]]] = {}
        for place, gram in enumerate(self.seeds.values):
            for i in self.owner[self.first[place] : self.first[place + 1]]:
                mine.setdefault(int(i), []).append((bool(owners[place] > SHARED), int(counts[place]), int(gram)))
        pairs = set()
        for i, own in mine.items():
            if not all(shared for shared, _, _ in own):
                own = [seed for seed in own if not seed[0]]
            live = sorted(seed[1:] for seed in own if seed[1])
            take = max(SEEDS, math.ceil(PART * len(live)))
            pairs |= {(gram, i) for _, gram in live[:take]}
        return self._of(self.ids, self.words, pairs)


def _grams(words: Words, width: int) -> np.ndarray:
    """The n-gram that begins at each word, over the whole chunk."""
    out = np.full(len(words.hashes), width, np.uint64)
    padded = np.concatenate((words.hashes, np.zeros(width, np.uint64)))
    for k in range(width):
        out = mix(out ^ padded[k : k + len(out)])
    return out


def _hits(words: Words, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of seeds in the order of the text, the seeds' places, and the rows that hold them."""
    found = []
    for width in items.widths:
        at, place = items.seeds.find(_grams(words, width))
        row = np.searchsorted(words.ptr, at, "right") - 1
        whole = at + width <= words.ptr[row + 1]
        found.append((at[whole], place[whole], row[whole]))
    at, place, row = (np.concatenate(parts) for parts in zip(*found, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], place[order], row[order]


def _counted(batches, items: Items) -> Iterator[pa.RecordBatch]:
    """(place, n): how often a task's documents have each seed."""
    counts = np.zeros(len(items.seeds.values), np.int64)
    for batch in batches:
        for words in words_of(batch.column(0)):
            counts += np.bincount(_hits(words, items)[1], minlength=len(counts))
    place = np.flatnonzero(counts)
    yield pa.RecordBatch.from_pydict({"place": pa.array(place, pa.int64()), "n": pa.array(counts[place])})


def _rare(documents: DataFrame, items: Items, text_column: str) -> Items:
    """Items with seeds that are rare in all documents. The counts that come here are those of the
    block's own n-grams."""
    texts = documents.select(F.col(f"`{text_column}`").alias("text"))
    counted = texts.mapInArrow(partial(_counted, items=items), "place long, n long")
    counts = np.zeros(len(items.seeds.values), np.int64)
    for row in counted.groupBy("place").agg(F.sum("n").alias("n")).collect():
        counts[row.place] = row.n
    return items.rare(counts)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment (Smith-Waterman): its points, and the first and last word of `text`."""
    score, last = _best_end(item, text)
    if not score:
        return 0, 0, -1
    back, length = _best_end(item[::-1], text[: last + 1][::-1])
    return score, last - length if back == score else 0, last


def _best_end(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    falling = GAP * np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1, np.int64)
    best, where = 0, -1
    for word in item:
        here = np.maximum(above - GAP, 0)
        here[1:] = np.maximum(here[1:], above[:-1] + np.where(text == word, MATCH, -MISMATCH))
        # a gap in the item: points fall along the row
        here = np.maximum.accumulate(here + falling) - falling
        top = int(here.argmax())
        if here[top] > best:
            best, where = int(here[top]), top - 1
        above = here
    return best, where


def _passages(at: np.ndarray, reach: int) -> Iterator[tuple[int, int]]:
    """Ranges of words, one copy of an item long, that begin and end with a seed."""
    begin = 0
    while begin < len(at):
        end = int(np.searchsorted(at, at[begin] + reach, "right"))
        yield int(at[begin]), int(at[end - 1])
        begin = end


def _matches(words: Words, items: Items) -> dict[int, list[dict]]:
    """By row of the chunk, the items that it holds copies of."""
    at, place, row = _hits(words, items)
    many = items.first[place + 1] - items.first[place]
    total = np.cumsum(many)
    out: dict[int, list[dict]] = {}
    begin = 0
    while begin < len(at):
        # whole rows at a time
        end = int(np.searchsorted(total, total[begin] - many[begin] + HITS, "right"))
        end = int(np.searchsorted(row, row[end], "left")) if end < len(at) else end
        if end <= begin:
            end = int(np.searchsorted(row, row[begin], "right"))
        part = slice(begin, end)
        _add_matches(out, words, items, at[part], place[part], row[part], many[part])
        begin = end
    return out


def _add_matches(
    out: dict[int, list[dict]], words: Words, items: Items,
    at: np.ndarray, place: np.ndarray, row: np.ndarray, many: np.ndarray,
) -> None:
    # each hit for each item that owns the seed
    hit = np.repeat(np.arange(len(at)), many)
    step = np.arange(len(hit)) - np.repeat(np.cumsum(many) - many, many)
    owner = items.owner[items.first[place[hit]] + step]
    at, row = at[hit], row[hit]
    order = np.lexsort((at, owner, row))
    at, row, owner = at[order], row[order], owner[order]
    cuts = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (owner[1:] != owner[:-1]), [True])))
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        r, i = int(row[begin]), int(owner[begin])
        if best := _best_copy(words, r, items, i, at[begin:end]):
            out.setdefault(r, []).extend({"item_id": item_id, **best} for item_id in items.ids[i])


def _best_copy(words: Words, row: int, items: Items, i: int, at: np.ndarray) -> dict | None:
    item = items.words[i]
    size = len(item)
    low, high = int(words.ptr[row]), int(words.ptr[row + 1])
    whole = MATCH * size
    limit = LIMIT if size >= SHORT else 1.0
    best = None
    for first, last in _passages(at, size + size // 2):
        # a passage of half a copy's points has at most twice its words
        begin, end = max(low, first - 2 * size), min(high, last + 2 * size + WIDTH)
        text = words.hashes[begin:end]
        if MATCH * np.isin(item, text).sum() < limit * whole:
            continue
        score, start, stop = align(item, text)
        if score >= limit * whole and (best is None or score > best["score"]):
            best = {
                "score": score, "ratio": score / whole,
                "first_word": begin - low + start, "last_word": begin - low + stop,
            }
            if score == whole:
                break
    return best


def _marked(batches, blocks: Items, text_column: str, leaks: str):
    for batch in batches:
        held = batch.schema.names.index(leaks)
        for words in words_of(batch.column(batch.schema.names.index(text_column))):
            rows = batch.slice(words.first, len(words))
            found = _matches(words, blocks)
            column = rows.column(held)
            if found:
                column = pa.array([old + found.get(i, []) for i, old in enumerate(column.to_pylist())], _FOUND)
            columns = [column if k == held else c for k, c in enumerate(rows.columns)]
            yield pa.RecordBatch.from_arrays(columns, rows.schema.names)


def _blocks(benchmark: DataFrame, item_column: str, text_column: str) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Ids and words of the items, in blocks of about BLOCK_BYTES of text, one at a time."""
    items = benchmark.select(
        F.col(f"`{item_column}`").cast("long").alias("item_id"), F.col(f"`{text_column}`").alias("text")
    ).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = size // BLOCK_BYTES + 1
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).distinct()
        rows = own.orderBy("item_id", "text").collect()
        ids, words = [], []
        for chunk in words_of(pa.array([r.text for r in rows], pa.large_string())):
            for i in range(len(chunk)):
                if chunk.ptr[i] < chunk.ptr[i + 1]:
                    ids.append(rows[chunk.first + i].item_id)
                    words.append(chunk.hashes[chunk.ptr[i] : chunk.ptr[i + 1]])
        if ids:
            yield ids, words


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
    leaks: str = "leaks",
) -> DataFrame:
    """All rows with a column `leaks`: the benchmark items of which the document holds an exact,
    edited or paraphrased copy, each with its points, their share of a whole copy's, and the first
    and last word of the passage. The best passage of an item is given.

    Items of fewer than SHORT words must occur word by word; items without words are ignored, and
    an id with several texts has each of them looked for. Null and empty documents hold nothing.
    Repeated rows are marked alike. A column named like `leaks` is replaced, others are kept. Empty
    tables give no rows, or empty lists.

    The n-grams of the items are counted in the documents first. Seeds of an item are the rare ones
    that occur: all but the most frequent eighth, and all but those that more than SHARED items
    have. A passage around a seed is aligned with the item if it has words enough in common to reach
    the limit at all. Of equally good passages of an item the first is given. Items of fewer words
    are looked for by seeds of their own width.
    The benchmark travels to the tasks in blocks of bounded size, the documents are not shuffled.
    """
    (kept,) = [without(documents, [leaks])]
    rows = kept.withColumn(leaks, F.array().cast(FOUND))
    for ids, words in _blocks(benchmark, item_column, item_text):
        items = _rare(kept, Items.of(ids, words), text_column)
        rows = rows.mapInArrow(partial(_marked, blocks=items, text_column=text_column, leaks=leaks), rows.schema)
    return rows
