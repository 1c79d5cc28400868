"""Whitening of embeddings from an exact, bit-sliced scatter matrix (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.store import Store
from marquee.sources.tables import spread

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE = 1024
SHIFT = 100_000
#: Rows whose bits are packed at a time.
BLOCK_ROWS = 1 << 14
#: Entries that wait for a block to be full, and numbers of finished blocks that a task holds, at
#: most, where there are vectors of many lengths.
WAITING = 1 << 24
HELD = 1 << 21
#: Sums are passed on in parts of so many bits, which longs add up exactly over 2^31 tasks.
PART_BITS = 32
#: The models of all vector lengths together are sent to every executor, so they may have this size.
MODEL_BYTES = 64 << 20
#: An eigenvalue below this share of the largest is zero up to rounding.
ZERO = 1e-13

_LOW = (1 << PART_BITS) - 1
_MOST = float(2**62)


def whole(values: np.ndarray) -> np.ndarray:
    """The long of each finite entry; entries beyond 2^62 / SCALE are put at that end."""
    return np.floor(np.clip(values * SCALE, -_MOST, _MOST)).astype(np.int64) + SHIFT


def vectors_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows that take part (neither null nor empty, all entries finite), and the lengths and
    entries of their vectors, one after the other."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)  # null entries become nan
    ends = np.cumsum(lengths)
    bad = np.concatenate(([0], np.cumsum(~np.isfinite(flat))))
    good = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    return np.flatnonzero(good), lengths[good], flat[np.repeat(good, lengths)]


def by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors as a matrix) for each length that occurs."""
    rows, lengths, flat = vectors_of(column)
    for length in np.unique(lengths):
        own = lengths == length
        yield rows[own], flat[np.repeat(own, lengths)].reshape(-1, length)


def planes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of a block: words (planes, rows / 64), and for each plane its dimension and bit.

    Each dimension is shifted by its least value, so it has as many planes as its spread has bits.
    The shifts come last.
    """
    least = x.min(axis=0)
    y = (x - least).astype(np.uint64)  # a difference of two longs fits an unsigned one
    bits = [int(top).bit_length() for top in y.max(axis=0)]
    dims = np.repeat(np.arange(x.shape[1]), bits)
    shift = np.concatenate([np.arange(b) for b in bits]).astype(np.uint64)
    words = np.zeros((len(dims), -(-len(y) // 64) * 8), np.uint8)
    for p, (j, b) in enumerate(zip(dims, shift, strict=True)):
        packed = np.packbits(((y[:, j] >> b) & np.uint64(1)).astype(np.uint8))
        words[p, : len(packed)] = packed
    return words.view(np.uint64), dims, shift, least


def cross_products(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each column, and of the products of each two columns, as exact Python integers.

    Two bit planes have as many rows in common as their AND has bits; weighted by the powers of two
    of both planes these counts add up to the products of the shifted columns.
    """
    n, d = x.shape
    words, dims, shift, least = planes(x)
    base = np.array([int(v) for v in least], object)
    sums, shifted = np.zeros(d, object), np.zeros((d, d), object)
    present, first = np.unique(dims, return_index=True)
    # counts of a block times 2^40 fit a long, and so do their sums for each dimension
    kind = np.int64 if len(shift) and shift.max() <= 40 else object
    power = np.array([1 << int(b) for b in shift], kind)
    for p in range(len(dims)):
        common = np.bitwise_count(words & words[p]).sum(axis=1, dtype=np.int64).astype(kind)
        weighted = np.add.reduceat(common * power, first).astype(object) * int(power[p])
        shifted[dims[p], present] += weighted
        sums[dims[p]] += int(common[p]) * int(power[p])
    products = shifted + np.outer(sums, base) + np.outer(base, sums) + n * np.outer(base, base)
    return sums + n * base, products


def _parts(value: int) -> list[int]:
    """A number as signed parts of PART_BITS, lowest first."""
    sign, value = (-1, -value) if value < 0 else (1, value)
    parts = []
    while value:
        parts.append(sign * (value & _LOW))
        value >>= PART_BITS
    return parts or [0]


class _Totals:
    """What a task has added up: for each length the rows, sums and products."""

    def __init__(self):
        self.numbers: dict[int, list] = {}
        self.waiting: dict[int, list[np.ndarray]] = {}
        self.entries = 0

    def add(self, x: np.ndarray) -> None:
        self.waiting.setdefault(x.shape[1], []).append(x)
        self.entries += x.size
        if sum(map(len, self.waiting[x.shape[1]])) >= BLOCK_ROWS:
            self._take(x.shape[1])
        elif self.entries > WAITING:
            for length in list(self.waiting):
                self._take(length)

    def _take(self, length: int) -> None:
        x = np.concatenate(self.waiting.pop(length))
        self.entries -= x.size
        own = self.numbers.setdefault(length, [0, 0, 0])
        for i, more in enumerate((len(x), *cross_products(x))):
            own[i] = own[i] + more

    def full(self) -> bool:
        return len(self.numbers) > 1 and sum(length * length for length in self.numbers) > HELD

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(length, j, k, part, value); k is -1 for sums, j and k are -1 for the rows."""
        for length in list(self.waiting):
            self._take(length)
        for length, (n, sums, products) in self.numbers.items():
            numbers = [(-1, -1, n), *((j, -1, s) for j, s in enumerate(sums))]
            numbers += [(j, k, products[j, k]) for j in range(length) for k in range(j, length)]
            out = [(length, j, k, p, v) for j, k, value in numbers for p, v in enumerate(_parts(int(value)))]
            columns = zip(*out, strict=True)
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["length", "j", "k", "part", "value"]
            )
        self.numbers = {}


def _gram(batches, column: str) -> Iterator[pa.RecordBatch]:
    totals = _Totals()
    for batch in batches:
        for _, vectors in by_length(batch.column(batch.schema.names.index(column))):
            for start in range(0, len(vectors), BLOCK_ROWS):
                totals.add(whole(vectors[start : start + BLOCK_ROWS]))
            if totals.full():
                yield from totals.rows()
    yield from totals.rows()


MODEL = "length int, n long, sums array<string>, components array<array<double>>, values array<double>, trace double"


def centred(n: int, sums: list[int], products: dict[tuple[int, int], int]) -> np.ndarray:
    """The covariance matrix: n * products - sums * sums in integers, then one division each."""
    d = len(sums)
    out = np.zeros((d, d))
    for (j, k), value in products.items():
        out[j, k] = out[k, j] = (n * value - sums[j] * sums[k]) / (n * n)
    return out


def _solve(frame: pd.DataFrame, components: int) -> pd.DataFrame:
    """The model of one vector length from the added up parts."""
    numbers: dict[tuple[int, int], int] = {}
    for j, k, part, value in frame[["j", "k", "part", "value"]].itertuples(index=False):
        numbers[j, k] = numbers.get((j, k), 0) + (int(value) << (PART_BITS * int(part)))
    length = int(frame["length"].iloc[0])
    n = numbers.pop((-1, -1))
    sums = [numbers.pop((j, -1)) for j in range(length)]
    cov = centred(n, sums, numbers)
    values, columns = np.linalg.eigh(cov)
    best = np.argsort(-values, kind="stable")[: min(components, length)]
    return pd.DataFrame({
        "length": [length], "n": [n], "sums": [[str(s) for s in sums]],
        "components": [columns[:, best].T.tolist()], "values": [values[best].tolist()], "trace": [float(np.trace(cov))],
    })


def fit(df: DataFrame, column: str, components: int) -> DataFrame:
    """One model for each vector length: rows, sums, components and eigenvalues.

    Each task adds up its own blocks and sends d * (d + 3) / 2 numbers; what meets in one task for
    a length is as much again for each part of 32 bits, whatever the number of rows.
    """
    parts = df.select(F.col(f"`{column}`").cast("array<double>").alias("v"))
    parts = parts.mapInArrow(partial(_gram, column="v"), "length int, j int, k int, part int, value long")
    added = parts.groupBy("length", "j", "k", "part").agg(F.sum("value").alias("value"))
    return added.groupBy("length").applyInPandas(partial(_solve, components=components), MODEL)


def _squares(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Exact sums of (n x - sums)^2 for each row, in longs where they cannot overflow."""
    top = max(abs(int(x.max())), abs(int(x.min()))) * n + max(abs(int(s)) for s in sums)
    if top * top * x.shape[1] < 1 << 63:
        off = x * n - sums.astype(np.int64)
        return (off * off).sum(axis=1).tolist()
    off = x.astype(object) * n - sums
    return (off * off).sum(axis=1).tolist()


def _whitened(batches, models) -> Iterator[pa.RecordBatch]:
    """Each row that takes part, with its deviation (as text) and its whitened vector."""
    for batch in batches:
        for rows, vectors in by_length(batch.column(1)):
            n, sums, axes, roots = models.value[vectors.shape[1]]
            centre = [s // n for s in sums]
            left = np.array([(s - n * c) / n for s, c in zip(sums, centre, strict=True)])
            for start in range(0, len(rows), BLOCK_ROWS):
                x = whole(vectors[start : start + BLOCK_ROWS])
                flat = (((x - np.array(centre, np.int64)) - left) @ axes.T / roots).ravel()
                ends = np.arange(0, len(flat) + 1, len(roots), dtype=np.int32)
                yield pa.RecordBatch.from_pydict({
                    "row": batch.column(0).take(pa.array(rows[start : start + BLOCK_ROWS])),
                    "length": pa.array(np.full(len(x), x.shape[1], np.int32)),
                    "deviation": pa.array(list(map(str, _squares(x, n, np.array(sums, object))))),
                    "w": pa.ListArray.from_arrays(ends, pa.array(flat, mask=np.isnan(flat))),
                })


def _identity_errors(kept: DataFrame, components: int) -> DataFrame:
    """(length, error): how far the whitened vectors' covariance is from the identity, at most."""
    w = [F.get("w", F.lit(a)) for a in range(components)]
    means = [F.avg(w[a]).alias(f"m{a}") for a in range(components)]
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    products = [F.avg(w[a] * w[b]).alias(f"p{a}_{b}") for a, b in pairs]
    found = kept.groupBy("length").agg(*means, *products)
    off = [
        F.abs(F.col(f"p{a}_{b}") - F.col(f"m{a}") * F.col(f"m{b}") - (1.0 if a == b else 0.0)) for a, b in pairs
    ]
    return found.select("length", F.array_max(F.array(*off)).alias("error"))


ADDED = ("n", "deviation", "whitened", "explained", "identity_error")


def whiten(
    df: DataFrame, column: str = "embedding", components: int = 8, carry: Sequence[str] | None = None
) -> DataFrame:
    """All rows whose vector takes part, with n (long), deviation (decimal(38,0)), whitened and
    explained (array<double>, by falling eigenvalue) and identity_error (double).

    An entry c becomes x = floor(1024 c) + 100000. The covariance V of the x-vectors comes from
    exact integers; `whitened` is x minus its mean, projected on V's first unit eigenvectors, over
    the roots of their eigenvalues; `explained` are the eigenvalues' shares of V's trace. `deviation`
    is the exact sum over dimensions of (n x - S)^2, null if it has over 38 digits.
    `identity_error` is the largest entry, by amount, of the covariance of all rows' whitened
    vectors minus the identity.

    Rows with a null or empty vector, or with a null or non-finite entry, are dropped. Vectors of
    different lengths are fitted and whitened apart; all its vectors are the fit list of a length.
    Components are fewer for shorter vectors. Where an eigenvalue is zero up to rounding (fewer rows
    than dimensions, dimensions without spread) its component of `whitened` is null and takes no
    part in identity_error; with a trace of zero `explained` is null. Entries beyond 2^62 / 1024 are
    put at that end. Repeated rows are rows like others; an empty table gives no rows. `carry` names
    the columns that stay, all by default; columns named like the new ones are replaced.
    """
    spark = df.sparkSession
    store = Store(spark, "whitening")
    stay = [c for c in (df.columns if carry is None else carry) if c.lower() not in ADDED]
    given = df.select(
        F.struct(*[f"`{c}`" for c in stay]).alias("row"), F.col(f"`{column}`").cast("array<double>").alias("v")
    )
    given = spread(given)
    models = store.keep(fit(given, "v", components), "models")
    size = models.agg(F.sum(F.col("length").cast("long") * (8 * components + 48)).alias("bytes")).collect()[0].bytes
    if (size or 0) > MODEL_BYTES:
        raise ValueError(f"models of {size} bytes, of all vector lengths, are too large to be sent to every executor")
    known = {}
    for m in models.collect():
        values = np.array(m["values"])
        roots = np.sqrt(np.where(values > ZERO * max(values[0], 0), values, np.nan))
        known[m.length] = (m.n, [int(s) for s in m.sums], np.array(m.components), roots)
    run = partial(_whitened, models=spark.sparkContext.broadcast(known))
    schema = T.StructType([
        given.schema["row"], T.StructField("length", T.IntegerType()), T.StructField("deviation", T.StringType()),
        T.StructField("w", T.ArrayType(T.DoubleType())),
    ])
    kept = store.keep(given.mapInArrow(run, schema), "whitened")
    shares = F.when(F.col("trace") > 0, F.transform("values", lambda e: e / F.col("trace"))).alias("explained")
    told = models.select("length", "n", shares).join(_identity_errors(kept, components), "length")
    return kept.join(F.broadcast(told), "length").select(  # told is smaller than the models
        "row.*",
        "n",
        F.col("deviation").try_cast("decimal(38,0)").alias("deviation"),
        F.col("w").alias("whitened"),
        "explained",
        F.col("error").alias("identity_error"),
    )
