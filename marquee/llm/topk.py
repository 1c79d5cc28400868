"""Exact top-k search by dual cover trees (operator 1)."""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm import covertree
from marquee.llm.store import Store

#: Vectors in a block of the index, and in a block of queries.
BLOCK_ROWS = 4096
QUERY_ROWS = 512
#: Pivots around which vectors are put into blocks, at most. They are read from the first rows of
#: a bounded, hashed choice; which ones they are changes only the time, not the result.
PIVOTS = 64
#: Query blocks that meet one data block in one task.
QUERY_BLOCKS = 32

TREE = "dim int, cell long, block long, tree binary, center array<double>, radius double, most double, n long"


def whole_numbers(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component; null for a vector that is null, empty, or holds a
    component that is null, not finite, or too large for a long."""
    numbers = F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(scale) * x))
    fine = F.forall(
        vector.cast("array<double>"), lambda x: F.coalesce(F.abs(F.lit(scale) * x) < F.lit(float(1 << 62)), F.lit(False))
    )
    return F.when(fine & (F.size(vector) > 0), numbers)


def _cell(rows: pd.DataFrame, pivots: dict[int, np.ndarray]) -> np.ndarray:
    out = np.zeros(len(rows), np.int64)
    for dim, own in pivots.items():
        at = np.flatnonzero(rows["dim"].to_numpy() == dim)
        if len(at):
            vectors = np.stack(rows["vector"].to_numpy()[at]).astype(np.float64)
            gaps = (own * own).sum(axis=1) - 2 * vectors @ own.T
            out[at] = gaps.argmin(axis=1)
    return out


def _celled(frames, pivots):
    for rows in frames:
        rows["cell"] = _cell(rows, pivots)
        yield rows


def _tree(rows: pd.DataFrame) -> pd.DataFrame:
    vectors = np.stack(rows["vector"].to_numpy()).astype(np.int64)
    tree = covertree.build(rows["id"].to_numpy(np.int64), vectors)
    return pd.DataFrame({
        "dim": [int(rows["dim"].iloc[0])], "cell": [int(rows["cell"].iloc[0])],
        "block": [int(rows["block"].iloc[0])], "tree": [tree.dump()], "center": [tree.center[0]],
        "radius": [float(tree.radius[0])], "most": [float(tree.most[0])], "n": [len(rows)],
    })


def _trees(rows: DataFrame, block_rows: int, store: Store, label: str) -> DataFrame:
    """A written cover tree for each block: the rows of a cell, spread over as many blocks as it
    fills. A cell with a third of all rows becomes many blocks."""
    counts = rows.groupBy("dim", "cell").agg(F.count("*").alias("rows"))
    order = Window.partitionBy("dim").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    blocks = counts.withColumn("parts", F.ceil(F.col("rows") / block_rows)).withColumn(
        "first", F.coalesce(F.sum("parts").over(order), F.lit(0))
    )
    # at most PIVOTS rows for each length of vectors
    placed = rows.join(F.broadcast(blocks.select("dim", "cell", "parts", "first")), ["dim", "cell"]).withColumn(
        "block", F.col("first") + F.pmod(F.xxhash64("id", "vector"), F.col("parts"))
    )
    return store.keep(
        placed.select("dim", "cell", "block", "id", "vector").groupBy("dim", "block").applyInPandas(_tree, TREE), label
    )


def _length(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))


def _gap(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))


def _reach(a: str, b: str) -> Column:
    """The largest product of a vector of `a` and one of `b`, blocks or cells, by the two bounds of
    `covertree.search`."""
    q, d = F.col(f"{a}.center"), F.col(f"{b}.center")
    qr, dr = F.col(f"{a}.radius"), F.col(f"{b}.radius")
    product = F.aggregate(F.zip_with(q, d, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    ball = product + _length(q) * dr + (_length(d) + dr) * qr
    gap = F.greatest(_gap(q, d) - qr - dr, F.lit(0.0))
    squares = F.col(f"{a}.most") * F.col(f"{a}.most") + F.col(f"{b}.most") * F.col(f"{b}.most")
    return F.least(ball, (squares - gap * gap) / 2) + squares * 1e-9 + 1e-6


def _cells(blocks: DataFrame) -> DataFrame:
    """A ball around the blocks of each cell: at most PIVOTS rows for each length of vectors."""
    middle = blocks.groupBy("dim", "cell").agg(F.min_by("center", "block").alias("middle"))
    return (
        blocks.join(middle, ["dim", "cell"])
        .groupBy("dim", "cell")
        .agg(
            F.first("middle").alias("center"),
            F.max(_gap(F.col("middle"), F.col("center")) + F.col("radius")).alias("radius"),
            F.max("most").alias("most"),
        )
    )


FOUND = "dim int, query_block long, query_id long, vec_id long, score long"


def _searched(key, queries: pd.DataFrame, data: pd.DataFrame, k: int) -> pd.DataFrame:
    parts = []
    for tree in data["d_tree"]:
        index = covertree.Tree.load(tree)
        for row in queries.itertuples():
            asked = covertree.Tree.load(row.tree)
            best = covertree.Best(len(asked.ids), k)
            if row.floor is not None:
                # a score below the query's known kth cannot count; ties may, by their ids
                best.scores[:] = np.asarray(row.floor, np.int64)[:, None]
            covertree.search(asked, index, best)
            at, of = np.nonzero(best.ids < np.iinfo(np.int64).max)
            parts.append(
                pd.DataFrame({
                    "dim": np.full(len(at), row.dim, np.int32),
                    "query_block": np.full(len(at), row.block, np.int64), "query_id": asked.ids[at],
                    "vec_id": best.ids[at, of], "score": best.scores[at, of],
                })
            )
    return pd.concat(parts) if parts else pd.DataFrame(
        {name: np.zeros(0, np.int64) for name in ("dim", "query_block", "query_id", "vec_id", "score")}
    )


def _floors(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The kth best score of each query of a block, in the order of its tree."""
    tree = covertree.Tree.load(rows["tree"].iloc[0])
    found = rows.dropna(subset=["query_id"])
    best = covertree.Best(len(tree.ids), k)
    if len(found):
        order = np.argsort(tree.ids, kind="stable")
        at = order[np.searchsorted(tree.ids[order], found["query_id"].to_numpy(np.int64))]
        best.offer(at, found["score"].to_numpy(np.int64), found["vec_id"].to_numpy(np.int64))
    floor = best.scores[:, -1]
    return pd.DataFrame({
        "dim": [int(rows["dim"].iloc[0])], "block": [int(rows["block"].iloc[0])], "floor": [floor.tolist()],
        "worst": [int(floor.min())],
    })


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: float = 256.0,
    pivots: int = PIVOTS,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """For each row where `queries` holds, its k best other rows by the inner product of whole
    numbers floor(scale * x): query_id, rank (from 1), vec_id, score. Ties go to the smaller id.

    Vectors that are null, empty, or hold a null, infinite, NaN or huge component take no part, nor
    do rows without an id. Vectors meet only those of their own length. A query's own row is the
    row with its id; rows that repeat an id and vector count once, and an id with several vectors
    keeps its best score. Fewer than k candidates give fewer rows; an empty table none. Other
    columns are ignored.

    Vectors are put into blocks around pivots and each block becomes a cover tree, written to the
    shared folder; so do the queries. Every query block first searches one data block of its own
    cell. The worst kth score it then has rules out, by covering radii and norms, first whole cells
    and then data blocks without a chance, so block pairs are made only of cells that are left; the
    rest is searched node pair by node pair.
    """
    store = Store(vectors.sparkSession, "topk")
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        whole_numbers(F.col(vector_column), scale).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).where("id is not null and vector is not null")
    rows = rows.withColumn("dim", F.size("vector"))
    chosen = (
        rows.select("dim", "vector")
        .withColumn("nth", F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("vector"), "vector")))
        .where(F.col("nth") <= pivots)
    )
    centers = {
        dim: np.stack(own["vector"].to_numpy()).astype(np.float64)
        for dim, own in chosen.toPandas().groupby("dim")
    }
    celled = store.keep(
        rows.mapInPandas(partial(_celled, pivots=centers), "id long, vector array<long>, asks boolean, dim int, cell long"),
        "cells",
    )
    data = _trees(celled.dropDuplicates(["id", "vector"]), block_rows, store, "data")
    asked = _trees(celled.where("asks").dropDuplicates(["id", "vector"]), query_rows, store, "queries")

    places = data.select("dim", "cell", "block", "center", "radius", "most")
    asks = asked.select("dim", "cell", "block", "center", "radius", "most")
    # a query is a row of its cell, so its cell has data blocks; they are random parts of the cell
    in_cell = Window.partitionBy("dim", "cell")
    turns = places.select(
        "dim", "cell", F.col("block").alias("data_block"),
        (F.row_number().over(in_cell.orderBy("block")) - 1).alias("nth"), F.count("*").over(in_cell).alias("parts"),
    )
    parts = turns.where("nth = 0").select("dim", "cell", "parts")
    home = store.keep(
        asks.select("dim", "cell", "block")
        .join(parts, ["dim", "cell"])
        .withColumn("nth", F.pmod(F.xxhash64("block"), F.col("parts")).cast("int"))
        .join(turns.drop("parts"), ["dim", "cell", "nth"])
        .select("dim", "block", "data_block"),
        "home",
    )

    def run(chosen: DataFrame, floors: DataFrame | None) -> DataFrame:
        """Search the chosen pairs of blocks; a task has one data block and a few query blocks."""
        some = chosen.join(asked.select("dim", "block", "tree"), ["dim", "block"])
        some = (
            some.withColumn("floor", F.lit(None).cast("array<long>"))
            if floors is None
            else some.join(floors.select("dim", "block", "floor"), ["dim", "block"])
        ).withColumn("turn", F.floor(F.col("block") / QUERY_BLOCKS))
        keys = ["dim", "data_block", "turn"]
        turns = some.select(*[F.col(c).alias(f"d_{c}") for c in keys]).distinct()
        index = data.select(F.col("dim").alias("d_dim"), F.col("block").alias("d_data_block"), F.col("tree").alias("d_tree"))
        index = turns.join(index, ["d_dim", "d_data_block"])
        return some.groupBy(*keys).cogroup(index.groupBy(*[f"d_{c}" for c in keys])).applyInPandas(
            lambda key, q, d: _searched(key, q, d, k), FOUND
        )

    first = store.keep(run(home, None), "first")
    floors = store.keep(
        asked.select("dim", "block", "tree")
        .join(first.withColumnRenamed("query_block", "block"), ["dim", "block"], "left")
        .groupBy("dim", "block")
        .applyInPandas(lambda rows: _floors(rows, k), "dim int, block long, floor array<long>, worst long"),
        "floors",
    )
    # descent: pairs of cells first, then the blocks of those that are left
    known = asks.join(floors.select("dim", "block", "worst"), ["dim", "block"])
    lowest = known.groupBy("dim", "cell").agg(F.min("worst").alias("worst"))
    q, d = _cells(asks).join(lowest, ["dim", "cell"]).alias("q"), _cells(places).alias("d")
    near = store.keep(
        q.join(d, F.col("q.dim") == F.col("d.dim"))
        .where(_reach("q", "d") >= F.col("q.worst"))
        .select(F.col("q.dim").alias("dim"), F.col("q.cell").alias("cell"), F.col("d.cell").alias("data_cell")),
        "near",
    )
    q = known.join(near, ["dim", "cell"]).alias("q")
    rest = store.keep(
        q.join(places.alias("d"), (F.col("q.dim") == F.col("d.dim")) & (F.col("q.data_cell") == F.col("d.cell")))
        .where(_reach("q", "d") >= F.col("q.worst"))
        .select(F.col("q.dim").alias("dim"), F.col("q.block").alias("block"), F.col("d.block").alias("data_block"))
        .join(home, ["dim", "block", "data_block"], "left_anti"),
        "rest",
    )
    found = first.unionByName(run(rest, floors)).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
