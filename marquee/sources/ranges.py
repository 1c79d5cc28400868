"""Files whose records may hold line ends, read by many tasks.

Spark's text source cuts a file into splits at a separator. Where records begin in a split depends
on what stands before it: whether a quote is open, and for JSON how deep it is nested. So each split
is read twice. The first pass tells for each way a split may begin (inside a string or not) how it
ends and how much deeper; these transitions, one row for each split, are composed in file order.
The second pass, knowing how each split begins, passes on the records that lie within it, and the
ends that hang over, of which each split has two at most; those are put together by their number.
No text is shuffled but these ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.operators.joins import BROADCAST_BYTES, fits
from marquee.session import materialize

# Characters of records after which a batch is passed on.
BATCH_CHARS = 1 << 21


@dataclass(frozen=True)
class Quoted:
    """CSV: the separator is a line end, and a record ends at one outside of quotes. Quotes inside
    a quoted field are doubled, so the state is the parity of all quotes."""

    separator: str = "\n"

    def step(self, piece: str, inside: bool, depth: int) -> tuple[bool, int]:
        return inside ^ bool(piece.count('"') & 1), depth

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside


_MARK = re.compile(r'["\\{}\[\]]')


@dataclass(frozen=True)
class Nested:
    """JSON: the separator is a closing brace, which is part of what stands before it. A record
    ends with an object that is not inside another one. In valid JSON a brace does not follow a
    backslash, so none is pending where a piece begins."""

    separator: str = "}"

    def step(self, piece: str, inside: bool, depth: int) -> tuple[bool, int]:
        skip = -1
        for found in _MARK.finditer(piece):
            at, sign = found.start(), found[0]
            if at == skip:
                continue
            if inside:
                if sign == "\\":
                    skip = at + 1
                elif sign == '"':
                    inside = False
            elif sign == '"':
                inside = True
            elif sign == "{":
                depth += 1
        return inside, depth if inside else depth - 1

    def ends(self, inside: bool, depth: int) -> bool:
        return not inside and depth <= 0


def read_pieces(spark: SparkSession, path: str | list[str], separator: str) -> DataFrame:
    """(value, file, block, size) in the order of each split, each piece without its separator."""
    text = spark.read.option("lineSep", separator).text(path)
    where = ("file_path", "file_block_start", "file_size")
    return text.select("value", *[F.col(f"_metadata.{w}").alias(n) for w, n in zip(where, ("file", "block", "size"), strict=True)])


def _splits(batches, names) -> Iterator[tuple[tuple, list[str]]]:
    """Runs of consecutive rows of one split, as (values of `names`, pieces)."""
    for batch in batches:
        columns = [batch.column(batch.schema.names.index(name)).to_pylist() for name in names]
        values = batch.column(0).to_pylist()
        start = 0
        keys = list(zip(*columns, strict=True))
        while start < len(keys):
            stop = start + 1
            while stop < len(keys) and keys[stop] == keys[start]:
                stop += 1
            yield keys[start], values[start:stop]
            start = stop


TRANSITION = (
    "file string, block long, bytes long, size long, out_inside boolean, out_depth long,"
    " in_inside boolean, in_depth long"
)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)))


def _transitions(batches, rule) -> Iterator[pa.RecordBatch]:
    found: dict[tuple, list] = {}
    for key, pieces in _splits(batches, ("file", "block", "size")):
        own = found.setdefault(key, [0, (False, 0), (True, 0)])
        for piece in pieces:
            own[0] += len(piece.encode()) + 1
            own[1:] = [rule.step(piece, *state) for state in own[1:]]
    if found:
        rows = [(file, block, n, size, *a, *b) for (file, block, size), (n, a, b) in found.items()]
        names = ["file", "block", "bytes", "size", "out_inside", "out_depth", "in_inside", "in_depth"]
        yield _rows(rows, names)


def _compose(frame: pd.DataFrame) -> pd.DataFrame:
    """The state in which each split of a file begins, and whether the separator behind its last
    piece is missing."""
    frame = frame.sort_values("block")
    inside, depth, begins = False, 0, []
    for row in frame.itertuples(index=False):
        begins.append((inside, depth))
        more = row.in_depth if inside else row.out_depth
        inside, depth = bool(row.in_inside if inside else row.out_inside), depth + int(more)
    last = np.arange(len(frame)) == len(frame) - 1
    unended = frame["bytes"].sum() > frame["size"].iloc[0]
    return pd.DataFrame({
        "file": frame["file"], "block": frame["block"], "inside": [b[0] for b in begins],
        "depth": [b[1] for b in begins], "unended": last & unended,
    })


WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


class _Cutter:
    """The records of one split, fed piece by piece."""

    def __init__(self, rule, inside: bool, depth: int, unended: bool):
        self.rule, self.state, self.unended = rule, (inside, depth), unended
        self.parts: list[str] = []
        self.seen = False
        self.held: str | None = None

    def feed(self, piece: str) -> tuple[int, str] | None:
        """Takes a piece; its forerunner, now known not to be the last one, may end a record."""
        piece, self.held = self.held, piece
        return None if piece is None else self._take(piece)

    def _take(self, piece: str) -> tuple[int, str] | None:
        self.parts.append(piece)
        self.state = self.rule.step(piece, *self.state)
        if not self.rule.ends(*self.state):
            return None
        found = (WHOLE if self.seen else HEAD, self._text())
        self.parts, self.seen = [], True
        return found

    def _text(self) -> str:
        return self.rule.separator.join(self.parts) + self.rule.separator

    def close(self) -> Iterator[tuple[int, str]]:
        if self.unended:
            self.parts.append(self.held)
            yield TAIL if self.seen else MIDDLE, self.rule.separator.join(self.parts)
            return
        found = self._take(self.held)
        if found:
            yield found
        if self.parts:
            yield TAIL if self.seen else MIDDLE, self._text()


def _cut(batches, rule) -> Iterator[pa.RecordBatch]:
    """(file, block, kind, value): whole records, the end of one that began in an earlier split
    (HEAD), a split that is in the middle of one, and the begin of one that goes on (TAIL)."""
    names = ["file", "block", "kind", "value"]
    out: list[tuple] = []
    chars = 0
    key = cutter = None
    for (file, block, inside, depth, unended), pieces in _splits(
        batches, ("file", "block", "inside", "depth", "unended")
    ):
        if key != (file, block):
            if cutter:
                out += [(*key, *found) for found in cutter.close()]
            key, cutter = (file, block), _Cutter(rule, inside, depth, unended)
        for piece in pieces:
            found = cutter.feed(piece)
            if found:
                out.append((*key, *found))
                chars += len(found[1])
                if chars >= BATCH_CHARS:
                    yield _rows(out, names)
                    out, chars = [], 0
    if cutter:
        out += [(*key, *found) for found in cutter.close()]
    if out:
        yield _rows(out, names)


def read_records(spark: SparkSession, path: str | list[str], rule) -> DataFrame:
    """(file, record, value): the text of each record, with its separators.

    `record` numbers the records that were put together from the ends of splits, from 0 in each
    file; the first record of a file is always one of them. It is null for the others. What stands
    behind the last record of a file is a record too.
    """
    pieces = read_pieces(spark, path, rule.separator)
    moves = pieces.mapInArrow(partial(_transitions, rule=rule), TRANSITION)
    begins = moves.groupBy("file").applyInPandas(
        _compose, "file string, block long, inside boolean, depth long, unended boolean"
    )
    begins = materialize(begins, "splits")
    pieces = pieces.drop("size")
    if fits(begins, BROADCAST_BYTES):
        started = pieces.join(F.broadcast(begins), ["file", "block"])  # keeps the order of pieces
    else:  # all pieces of a split come from one task, whose ids grow
        numbered = pieces.withColumn("seq", F.monotonically_increasing_id())
        started = numbered.join(begins, ["file", "block"]).sortWithinPartitions("file", "block", "seq")
    cut = started.select("value", "file", "block", "inside", "depth", "unended").mapInArrow(
        partial(_cut, rule=rule), "file string, block long, kind long, value string"
    )
    ends = materialize(cut.where(F.col("kind") != WHOLE), "ends")
    # The number of the ends' record grows behind each head.
    order = Window.partitionBy("file").orderBy("block", "kind")
    closed = F.sum((F.col("kind") == HEAD).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbered = ends.select("file", "block", "kind", "value", F.coalesce(closed, F.lit(0)).alias("record"))
    joined = numbered.groupBy("file", "record").agg(
        F.array_sort(F.collect_list(F.struct("block", "kind", "value"))).alias("parts")
    )
    joined = joined.select("file", "record", F.concat_ws("", "parts.value").alias("value"))
    whole = cut.where(F.col("kind") == WHOLE).select("file", F.lit(None).cast("long").alias("record"), "value")
    return whole.unionByName(joined)
