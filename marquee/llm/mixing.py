"""Mixing sources to target weights by hierarchical budgets (operator 2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.columns import fresh, without
from marquee.llm.store import Store
from marquee.operators.joins import join_many_to_one

#: Rows of a leaf among which the end of its prefix is looked for, about.
BUCKET_ROWS = 4096
KEY_BITS = 60


def tokens(text: Column) -> Column:
    """Words of a text, which stand for its tokens; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _number(text: Column) -> Column:
    """The first 60 bits of an MD5 digest."""
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def _place(seed: int, epoch: Column, key: Column) -> Column:
    """Where a row stands in the order of an epoch."""
    return _number(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), key))


def _weight(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    """A node's weight among its siblings; 1 if none is given."""
    given = weights.get(level, {})
    if not given:
        return F.lit(1.0)
    return F.coalesce(F.create_map(*[F.lit(x) for pair in given.items() for x in pair])[F.col(level)].cast("double"), F.lit(1.0))


def fill(nodes: DataFrame, parents: Sequence[str]) -> DataFrame:
    """Share each parent's `budget` among its children by `weight`, none above its `cap`.

    What a child cannot take goes to its siblings, by their weights. A child is full if its cap is
    below its share of what the children with a smaller cap for their weight have left; the first
    one that is not full sets the rate for all that are not.
    """
    order = (Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))).orderBy(
        F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf"))), "node"
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights = F.sum("weight").over(onwards)
    rated = nodes.withColumn("rate", F.when(weights > 0, left / weights).otherwise(F.lit(0.0))).withColumn(
        "full", F.col("cap") <= F.col("rate") * F.col("weight")
    )
    open_ = rated.withColumn("open", F.max(F.when(F.col("full"), 0).otherwise(1)).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ))
    rate = F.first(F.when(F.col("open") == 1, F.col("rate")), ignorenulls=True).over(whole)
    return open_.withColumn("level_rate", rate).withColumn(
        "share", F.when(F.col("open") == 0, F.col("cap")).otherwise(F.col("level_rate") * F.col("weight"))
    )


def budgets(
    leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], budget: float, epochs: int
) -> DataFrame:
    """A row for each leaf (levels, tokens) with its budget of tokens, a long.

    Budgets go down the tree. A node's cap is what its leaves hold in `epochs` passes, so a leaf's
    shortage is made up by its siblings as far as they can, then by its parent's siblings.
    """
    caps = leaves.withColumn("cap", (F.col("tokens") * epochs).cast("double"))
    above = caps.agg(F.least(F.sum("cap"), F.lit(float(budget))).alias("budget"))
    for depth, level in enumerate(levels):
        keys, parents = list(levels[: depth + 1]), list(levels[:depth])
        nodes = caps.groupBy(*keys).agg(F.sum("cap").alias("cap"))
        # one row at the root, else a row for each parent
        nodes = nodes.join(above, parents) if parents else nodes.join(F.broadcast(above), F.lit(True))
        nodes = nodes.withColumn("weight", _weight(level, weights)).withColumn("node", F.col(level))
        above = fill(nodes, parents).select(*keys, F.col("share").alias("budget"))
    return leaves.join(above, list(levels)).withColumn("budget", F.floor("budget"))


def mix(
    documents: DataFrame,
    weights: Mapping[str, Mapping[str, float]],
    budget: float,
    levels: Mapping[str, Column],
    epochs: int = 4,
    seed: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
    epoch: str = "epoch",
) -> DataFrame:
    """Rows chosen so that the leaves of a tree hold their weights' share of `budget` tokens; a row
    is repeated for each epoch (from 0) that it is in.

    `levels` names the levels of the tree from the top and gives each row's node; null is a node
    like others, named by the empty text. `weights` gives the nodes' weights among their siblings
    by level; nodes that are not listed weigh 1, nodes of weight 0 get nothing. A leaf gives at most
    `epochs` passes; what it lacks goes to its siblings, then to those of its ancestors.

    A leaf's budget covers whole passes and a prefix of one more, in an order of rows drawn from
    the seed, the epoch and the row's id and text. The prefix ends before the row that would exceed
    the budget; rows of equal id and text are taken together. Null and empty texts have no tokens
    and come with the prefix that they stand in. The column `epoch` replaces one of that name. An
    empty table stays empty.

    Only the end of each prefix is looked for: sums over parts of the order find the part, its rows
    the place. Then the rows are filtered, without being shuffled, by a table of leaves.
    """
    store = Store(documents.sparkSession, "mixing")
    rows = without(documents, [epoch])
    names = fresh(rows, *[f"level_{name}" for name in levels])
    key, until, passes = fresh(rows, "row_key", "until", "passes")
    id_, text = F.col(f"`{id_column}`").cast("string"), F.col(f"`{text_column}`")
    keyed = rows.withColumns(
        {n: F.coalesce(c.cast("string"), F.lit("")) for n, c in zip(names, levels.values(), strict=True)}
    ).withColumn(key, F.md5(F.concat_ws(":", F.coalesce(id_, F.lit("")), F.coalesce(text, F.lit("")))))
    sizes = store.keep(
        keyed.select(*[F.col(n).alias(l) for n, l in zip(names, levels, strict=True)], F.col(key).alias("key"), tokens(text).alias("tokens")),
        "sizes",
    )
    leaf = list(levels)
    leaves = sizes.groupBy(*leaf).agg(F.sum("tokens").alias("tokens"))
    plan = budgets(leaves, leaf, weights, budget, epochs)
    plan = plan.withColumn("passes", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(F.lit(0)))
    plan = store.keep(plan.withColumn("rest", F.col("budget") - F.col("passes") * F.col("tokens")), "plan")
    ends = store.keep(_ends(sizes, plan, leaf, seed), "ends")
    renamed = ends.select(
        *[F.col(l).alias(n) for n, l in zip(names, leaf, strict=True)],
        F.col("until").alias(until), F.col("passes").alias(passes),
    )
    joined = join_many_to_one(keyed, renamed, names)
    last = F.when(_place(seed, F.col(passes), F.col(key)) <= F.col(until), 1).otherwise(0)
    copies = joined.withColumn(epoch, F.col(passes) + last).where(F.col(epoch) > 0)
    kept = [f"`{c}`" for c in rows.columns]
    return copies.select(*kept, F.explode(F.sequence(F.lit(0), (F.col(epoch) - 1).cast("int"))).alias(epoch))


def _ends(sizes: DataFrame, plan: DataFrame, leaf: list[str], seed: int) -> DataFrame:
    """(leaf, passes, until): rows of the last epoch are taken up to the place `until`."""
    bits = max(6, (sizes.count() // BUCKET_ROWS).bit_length())
    placed = join_many_to_one(sizes, plan.select(*leaf, "passes", "rest"), leaf)
    placed = placed.withColumn("place", _place(seed, F.col("passes"), F.col("key"))).withColumn(
        "part", F.shiftright("place", KEY_BITS - bits)
    )
    parts = placed.groupBy(*leaf, "passes", "rest", "part").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy(*leaf).orderBy("part")
    summed = parts.withColumn("upto", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    # the first part that does not fit holds the end; before it all rows are taken
    cut = summed.groupBy(*leaf, "passes", "rest").agg(
        F.min(F.when(F.col("upto") > F.col("rest"), F.struct("part", (F.col("upto") - F.col("tokens")).alias("below")))).alias("cut")
    )
    inner = placed.join(
        cut.where("cut is not null").select(*leaf, F.col("cut.part").alias("part"), F.col("cut.below").alias("below")),
        [*leaf, "part"],
    )
    same = Window.partitionBy(*leaf).orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    fits = inner.withColumn("upto", F.col("below") + F.sum("tokens").over(same)).where(F.col("upto") <= F.col("rest"))
    inside = fits.groupBy(*leaf).agg(F.max("place").alias("last"))
    start = F.shiftleft(F.col("cut.part"), KEY_BITS - bits) - 1
    until = F.when(F.col("cut").isNull(), F.lit(1 << KEY_BITS)).otherwise(F.coalesce("last", start))
    return cut.join(inside, leaf, "left").select(*leaf, "passes", until.alias("until"))


#: Weights and sizes of the corpus mix. Sources have no domain of their own, so their number gives
#: them one.
DOMAINS = ("web", "news", "books", "forum")
WEIGHTS: dict[str, dict[str, float]] = {
    "domain": {"web": 0.4, "news": 0.25, "books": 0.2, "forum": 0.15},
    "language": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
}


def corpus_levels() -> dict[str, Column]:
    number = F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(0))
    domain = F.element_at(F.array(*[F.lit(d) for d in DOMAINS]), (number % len(DOMAINS) + 1).cast("int"))
    return {"domain": domain, "language": F.col("lang"), "source": F.col("source")}


def corpus_budget(documents: DataFrame, share: float = 0.9) -> float:
    """So much of all tokens of a corpus."""
    return share * (documents.agg(F.sum(tokens(F.col("text")))).first()[0] or 0)


