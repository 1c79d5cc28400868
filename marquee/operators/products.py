"""The k largest inner products of every user vector with the item vectors, without all pairs.

Items are put in order of falling norm and cut into blocks. A user's product with an item is at most
the product of their norms, so once a user's kth best score is above its norm times a block's
largest norm, neither this block nor any later one holds a better item. Blocks are taken in rounds
of doubling size, up to a bound; in each round only users that can still gain meet the blocks that they can gain
from, and inside a block only the items whose own norm may suffice are multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.operators.joins import join_many_to_one
from marquee.operators.ordering import top_per_group, with_rank
from marquee.session import discard_table, freed_shuffles, materialize

# Items and users whose products one call computes.
BLOCK_ITEMS = 2_048
BLOCK_USERS = 2_048
# Pieces for each core that the pairs of blocks of one round are dealt into.
TASKS_PER_CORE = 4
# Item blocks of one round, so that they can be sent to all tasks: a shuffle of pairs of blocks would
# carry a block of users once for each block of items.
ROUND_BLOCKS = 64
# Rounding may lower a bound by less than this part of it.
MARGIN = 1e-9

PAIR = "user long, item long, score double, multiplied long"


def _norm(column: str):
    squares = F.transform(column, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda a, b: a + b))


def item_blocks(items: DataFrame, size: int) -> DataFrame:
    """(block, top, ids, norms, factors) by falling norm; `items` has (id, features)."""
    ranked = with_rank(items.select("id", "features", _norm("features").alias("norm")), [F.desc("norm"), "id"])
    rows = ranked.select(((F.col("rank") - 1) / size).cast("int").alias("block"), "rank", "id", "norm", "features")
    cells = rows.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "norm", "features"))).alias("c"))
    return cells.select(
        "block",
        F.col("c")[0]["norm"].alias("top"),
        F.col("c.id").alias("ids"),
        F.col("c.norm").alias("norms"),
        F.flatten("c.features").alias("factors"),
    )


def _user_blocks(active: DataFrame, size: int) -> DataFrame:
    """(part, users, needs, floors, least, factors): users with the norm and the score that an item
    needs to be of use, and the least such norm."""
    parts = active.count() // size + 1
    part = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(parts)).cast("int").alias("part")
    if "floor" not in active.columns:
        active = active.withColumn("floor", F.lit(float("-inf")))
    cells = active.select(part, F.struct("id", "need", "floor", "features").alias("c")).groupBy("part")
    cells = cells.agg(F.sort_array(F.collect_list("c")).alias("c"))
    return cells.select(
        "part",
        F.col("c.id").alias("users"),
        F.col("c.need").alias("needs"),
        F.col("c.floor").alias("floors"),
        F.array_min("c.need").alias("least"),
        F.flatten("c.features").alias("factors"),
    )


def _pairs(parts: DataFrame, span: DataFrame, first: int, last: int, tasks: int) -> DataFrame:
    """The user and item blocks (from `first`, before `last`) that can gain from each other, dealt
    over about `tasks` pieces also where there are few item blocks."""
    pairs = parts.withColumn("block", F.explode(F.sequence(F.lit(first), F.lit(last - 1))))
    tops = span.select("block", "top")
    pairs = join_many_to_one(pairs.select("part", "least", "block"), tops, "block")
    # The first rounds have few blocks: copies of them, one for each slot, go to all tasks.
    slots = max(1, tasks // (last - first))
    slot = F.pmod(F.xxhash64("part"), F.lit(slots)).alias("slot")
    pairs = pairs.where(F.col("top") >= F.col("least")).select("part", "block", slot)
    pairs = pairs.repartition(tasks, "part", "block")
    pairs = join_many_to_one(pairs, parts.withColumnRenamed("factors", "user_factors"), "part")
    span = span.withColumnRenamed("factors", "item_factors")
    span = span.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)).cast("array<bigint>")))
    return join_many_to_one(pairs, span, ["block", "slot"])


def _multiply(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """For each pair of blocks the k best items of each user, as far as they reach the user's floor,
    and how many products that took.

    The number stands in the first row of a pair of blocks, which has no item where none is found.
    """
    for batch in batches:
        rows = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for i in range(batch.num_rows):
            def take(name, kind, i=i):
                return np.asarray(rows[name][i].values).astype(kind)

            users, needs, floors = take("users", np.int64), take("needs", float), take("floors", float)
            ids, norms = take("ids", np.int64), take("norms", float)
            left = take("user_factors", float).reshape(len(users), -1)
            right = take("item_factors", float).reshape(len(ids), -1)
            # norms fall, so what may be of use to a user is a prefix of the block
            reach = np.searchsorted(-norms, -needs, "right")
            order = np.argsort(-reach, kind="stable")
            out_users, out_items, out_scores = [], [], []
            # users of like reach are multiplied together
            for group in np.array_split(order, max(1, len(order) // 128)):
                width = int(reach[group].max())
                if not width:
                    continue
                scores = left[group] @ right[:width].T
                inside = np.arange(width) < reach[group][:, None]
                floor = floors[group][:, None]
                inside &= (scores >= floor) | (floor == -np.inf)
                value = np.where(inside & ~np.isnan(scores), scores, -np.inf)
                if width > k:
                    inside &= value >= np.partition(value, width - k, axis=1)[:, width - k, None]
                row, place = np.nonzero(inside)
                best = np.lexsort((ids[place], -value[row, place], row))
                row, place = row[best], place[best]
                first = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, place = row[first], place[first]
                out_users.append(users[group][row])
                out_items.append(ids[place])
                out_scores.append(scores[row, place])
            if not out_users:
                continue
            found = np.concatenate(out_users)
            columns = [found, np.concatenate(out_items), np.concatenate(out_scores)]
            nothing = not len(found)
            multiplied = np.zeros(len(found) + nothing, np.int64)
            multiplied[:1] = int(reach.sum())
            columns = [pa.array([x], pa.from_numpy_dtype(c.dtype)) if nothing else pa.array(c) for c, x in zip(columns, (users[0], None, None), strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(multiplied)], ["user", "item", "score", "multiplied"])


def top_products(
    users: DataFrame,
    items: DataFrame,
    k: int,
    *,
    block_items: int = BLOCK_ITEMS,
    block_users: int = BLOCK_USERS,
) -> DataFrame:
    """(user, rank, item, score, multiplied): the k items with the largest inner product for each
    user, ties by the smaller item; with fewer items, all of them.

    Both frames have (id, features), ids unique, vectors of one length. The sum of `multiplied` is
    the number of products that were computed. Nothing but block numbers and their largest norms,
    one row for each block, is collected or broadcast without a look at its size; a round reads only the users that it
    still concerns.
    """
    with freed_shuffles(users.sparkSession):
        return _top_products(users, items, k, block_items, block_users)


def _top_products(users: DataFrame, items: DataFrame, k: int, block_items: int, block_users: int) -> DataFrame:
    blocks = materialize(item_blocks(items, block_items), "item-blocks")
    count = blocks.count()
    people = materialize(users.select("id", "features", _norm("features").alias("norm")), "users")
    empty = users.sparkSession.createDataFrame([], PAIR)
    best = empty
    first, size, known = 0, 1, None
    tasks = TASKS_PER_CORE * users.sparkSession.sparkContext.defaultParallelism
    active = people.where("norm > 0").withColumn("need", F.lit(-1.0))
    while first < count and not active.isEmpty():
        last = min(first + size, count)
        parts = materialize(_user_blocks(active, block_users), "user-blocks")
        if known is not None:
            discard_table(known)
        span = blocks.where(F.col("block").between(first, last - 1))
        pairs = _pairs(parts, span, first, last, tasks)
        # A row holds two blocks; so few rows are passed to Python at a time.
        needed = pairs.select("users", "needs", "floors", "user_factors", "ids", "norms", "item_factors")
        found = needed.mapInArrow(partial(_multiply, k=k), PAIR)
        counted = best.unionByName(found).withColumn("multiplied", F.sum("multiplied").over(Window.partitionBy("user")))
        counted = counted.where("item IS NOT NULL")
        older, best = best, top_per_group(counted, ["user"], [F.desc("score"), F.asc("item")], k)
        spent = F.when(F.col("rank") == 1, F.col("multiplied")).otherwise(0).alias("multiplied")
        best = materialize(best.select("user", "item", "score", spent), "best")
        for table in (parts, older) if first else (parts,):
            discard_table(table)
        first, size = last, min(size * 2, ROUND_BLOCKS)
        # A user with k scores needs an item of at least this norm; one without them needs any.
        kth = best.groupBy(F.col("user").alias("id")).agg(F.min("score").alias("kth"), F.count("*").alias("n"))
        known = materialize(kth, "one")
        active = join_many_to_one(people.where("norm > 0"), known, "id", "left")
        enough = F.coalesce("n", F.lit(0)) >= k
        need = F.when(enough, F.col("kth") / F.col("norm") * (1 - MARGIN)).otherwise(-1.0)
        active = active.withColumns({"need": need, "floor": F.when(enough, F.col("kth")).otherwise(float("-inf"))})
        if first < count:
            ahead = blocks.where(F.col("block") == first).select("top").first().top
            active = active.where(F.col("need") <= ahead).select("id", "features", "norm", "need", "floor")
    # Every item is as good as any other to a user whose vector is zero.
    ids = [row.id for row in items.select("id").orderBy("id").limit(k).collect()]
    nothing = people.where("norm = 0").select(
        F.col("id").alias("user"),
        F.explode(F.array(*map(F.lit, ids)).cast("array<long>")).alias("item"),
        F.lit(0.0).alias("score"),
        F.lit(0).cast("long").alias("multiplied"),
    )
    ranked = top_per_group(best.unionByName(nothing), ["user"], [F.desc("score"), F.asc("item")], k)
    return ranked.select("user", "rank", "item", "score", "multiplied")
