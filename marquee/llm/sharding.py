"""Shards of equal bytes by histogram sort (operator 7); DataFrame functions only."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.columns import fresh, without
from marquee.llm.store import Store
from marquee.operators.joins import join_many_to_one

#: A key is two numbers of 60 bits, from a digest of the text and one of the id.
KEY_BITS = 60
#: A round looks at so many further bits: 1,024 probes for each splitter.
PROBE_BITS = 10
LEVELS = 2 * KEY_BITS // PROBE_BITS
#: Bytes that a row counts besides its text.
ROW_BYTES = 16
#: Rows of a shard that one task numbers.
SLOT_ROWS = 1 << 20


def _number(value: Column) -> Column:
    """The first 60 bits of the MD5 digest of the value's text."""
    text = F.coalesce(value.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))


@dataclass
class _Splitter:
    """Looks for the key at which `target` bytes lie below; `below` lie below its cell."""

    target: float
    cell: tuple[int, int]
    below: int = 0
    bound: tuple[int, int] | None = None
    done: bool = False


def _cell(level: int) -> list[Column]:
    """The first `level` groups of bits of the key columns `a` and `b`."""
    bits = level * PROBE_BITS
    first = F.shiftright("a", KEY_BITS - min(bits, KEY_BITS)).alias("p")
    if bits <= KEY_BITS:
        return [first, F.lit(0).cast("long").alias("q")]
    return [first, F.shiftright("b", 2 * KEY_BITS - bits).alias("q")]


def _start(level: int, cell: tuple[int, int]) -> tuple[int, int]:
    """The smallest key of a cell."""
    bits = level * PROBE_BITS
    if bits <= KEY_BITS:
        return cell[0] << (KEY_BITS - bits), 0
    return cell[0], cell[1] << (2 * KEY_BITS - bits)


def _after(level: int, cell: tuple[int, int]) -> tuple[int, int]:
    """The smallest key above a cell; it may be too large for any row."""
    bits = level * PROBE_BITS
    if bits > KEY_BITS and (cell[1] + 1) << (2 * KEY_BITS - bits) >= 1 << KEY_BITS:
        return cell[0] + 1, 0
    if bits > KEY_BITS:
        return _start(level, (cell[0], cell[1] + 1))
    return _start(level, (cell[0] + 1, 0))


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.0) -> list[tuple[int, int]]:
    """Keys at which the next shard begins; `keys` has columns a, b (the key) and size.

    In each round one aggregate counts the exact bytes of the cells between the probes of all
    splitters that are still open: at most `shards` * 2 ** PROBE_BITS rows come to the driver,
    whatever the number of keys. A splitter is found when an edge of its cell lies within
    `tolerance` * (bytes of a shard) of its target, or its cell holds a single key; the nearer edge
    is then taken. Rows of equal keys stay together.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    slack = tolerance * total / shards
    open_ = [_Splitter(total * j / shards, (0, 0)) for j in range(1, shards)]
    found = list(open_)
    level = 0
    while open_:
        level += 1
        cells = _histogram(keys, level, sorted({s.cell for s in open_}))
        for splitter in open_:
            _refine(splitter, level, cells[splitter.cell], slack)
        open_ = [s for s in open_ if not s.done]
    return [s.bound for s in found]


def _histogram(keys: DataFrame, level: int, cells: list[tuple[int, int]]) -> dict:
    """For each given cell of the level above: its cells (cell, bytes, whether one key) in order."""
    upper = _cell(level - 1)
    rows = keys
    if level > 1:
        bits = (level - 1) * PROBE_BITS
        if bits <= KEY_BITS:
            rows = keys.where(upper[0].isin([p for p, _ in cells]))
        else:
            pairs = [(F.col("a") == p) & (upper[1] == q) for p, q in cells]
            rows = keys.where(reduce(lambda x, y: x | y, pairs))
    key = F.struct("a", "b")
    counted = (
        rows.groupBy(upper[0].alias("up"), upper[1].alias("uq"), *_cell(level))
        .agg(F.sum("size").alias("bytes"), (F.min(key) == F.max(key)).alias("one"))
        .collect()
    )
    out: dict = {cell: [] for cell in cells}
    for row in sorted(counted, key=lambda r: (r.p, r.q)):
        out[(row.up, row.uq) if level > 1 else (0, 0)].append(((row.p, row.q), row.bytes, row.one))
    return out


def _refine(splitter: _Splitter, level: int, cells: list, slack: float) -> None:
    edges = [splitter.below]
    for _, size, _ in cells:
        edges.append(edges[-1] + size)
    at = min(max(bisect_right(edges, splitter.target) - 1, 0), len(cells) - 1)
    cell, _, one = cells[at]
    low, high = splitter.target - edges[at], edges[at + 1] - splitter.target
    splitter.done = one or min(low, high) <= slack or level == LEVELS
    if splitter.done:
        splitter.bound = _start(level, cell) if low <= high else _after(level, cell)
    else:
        splitter.cell, splitter.below = cell, edges[at]


def shard_by_bytes(
    docs: DataFrame,
    shards: int = 40,
    id_column: str = "doc_id",
    text_column: str = "text",
    tolerance: float = 0.0,
) -> DataFrame:
    """All rows with `shard` (from 0) and `slot` (their place in the shard, gapless from 0).

    A row counts the UTF-8 bytes of its text (none for null) plus 16, and the shards' sums differ
    from their mean by no more than about one row. Rows are sorted by a digest of the text and then
    one of the id (null counts as empty in both), so equal texts stand together and a text that
    owns many shards is cut between ids. Rows with equal text and id stay in one shard, side by
    side. Columns named shard or slot are replaced; others are kept. An empty table stays empty.

    The splitters are refined on a written table of keys and sizes, then all rows are exchanged
    once. A shard's rows are numbered in parts of about a million rows.
    """
    spark = docs.sparkSession
    store = Store(spark, "shards")
    rows = without(docs, ["shard", "slot"])
    text, id_ = F.col(f"`{text_column}`"), F.col(f"`{id_column}`")
    keys = store.keep(
        rows.select(_number(text).alias("a"), _number(id_).alias("b"), (text_bytes(text) + ROW_BYTES).alias("size")),
        "keys",
    )
    bounds = splitters(keys, shards, tolerance)
    a, b, part = fresh(rows, "key_a", "key_b", "part")

    edges = F.array(*[F.struct(F.lit(p).alias("a"), F.lit(q).alias("b")) for p, q in bounds])

    def shard_of(first: str, second: str) -> Column:
        if not bounds:
            return F.lit(0)
        key = F.struct(F.col(first).alias("a"), F.col(second).alias("b"))
        return F.size(F.filter(edges, lambda edge: edge <= key))

    # parts of a shard by the leading bits of the key: of the text's, or of the id's for hot texts
    counts = keys.groupBy(F.shiftright("a", KEY_BITS - PROBE_BITS)).count()
    many, most = keys.count(), counts.agg(F.max("count")).first()[0] or 0
    bits = max(0, (many // SLOT_ROWS).bit_length())
    hot_bits = max(0, (most // SLOT_ROWS).bit_length()) if most > 4 * SLOT_ROWS else 0

    def part_of(first: str, second: str) -> Column:
        high = F.shiftright(first, KEY_BITS - bits) if bits else F.lit(0).cast("long")
        low = F.shiftright(second, KEY_BITS - hot_bits) if hot_bits else F.lit(0).cast("long")
        return F.shiftleft(high, hot_bits) + low

    sizes = keys.groupBy(shard_of("a", "b").alias("shard"), part_of("a", "b").alias(part)).agg(
        F.count("*").alias("rows")
    )
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("slot"))
    placed = (
        rows.withColumns({a: _number(text), b: _number(id_)})
        .withColumn("shard", shard_of(a, b))
        .withColumn(part, part_of(a, b))
    )
    (nth,) = fresh(placed, "nth")
    order = Window.partitionBy("shard", part).orderBy(a, b, f"`{id_column}`")
    numbered = placed.withColumn(nth, F.row_number().over(order))
    out = join_many_to_one(numbered, offsets, ["shard", part], derived=True)
    kept = [f"`{name}`" for name in rows.columns]
    return out.select(*kept, "shard", (F.col("slot") + F.col(nth) - 1).alias("slot"))
