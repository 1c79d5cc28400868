"""Removal of lines that spread over sites (operator 4); DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.columns import fresh, without
from marquee.llm.store import Store
from marquee.operators.joins import join_many_to_one

#: Sites on which a line is boilerplate. A passage of 20 copies stands on so many with near
#: certainty even where one source holds a third of all rows.
MIN_SITES = 5
#: Sketches have 2 ** LG_K registers; their relative error is about 1.04 / 2 ** (LG_K / 2).
LG_K = 8
#: Estimates within so many times the error are checked by exact counts.
ERRORS = 4


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _stripped(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def _key(line: Column) -> Column:
    """96 bits of hash for a stripped line; null if it is empty."""
    line = _stripped(line)
    return F.when(line != "", F.struct(F.xxhash64(line).alias("h"), F.hash(line).alias("g")))


def spread_lines(
    documents: DataFrame, min_sites: int, store: Store, site_column: str, text_column: str, lg_k: int = LG_K
) -> DataFrame:
    """Keys of the lines that occur on at least `min_sites` distinct sites.

    Sketches of the sites of each line are merged by aggregation, so a line of any frequency
    travels as one small sketch from each task. Only lines whose estimate is within `ERRORS` times
    the sketch's error of the threshold are counted exactly.
    """
    site = F.coalesce(F.col(f"`{site_column}`").cast("string"), F.lit("")).alias("site")
    lines = documents.select(site, F.explode(F.transform(_lines(F.col(f"`{text_column}`")), _key)).alias("key")).where(
        "key is not null"
    )
    band = ERRORS * 1.04 / 2 ** (lg_k / 2)
    sketched = (
        lines.groupBy("key")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"))
        .where(F.col("sites") >= min_sites * (1 - band) - 1)
    )
    likely = store.keep(sketched, "likely")
    sure = F.col("sites") > min_sites * (1 + band) + 1
    near = likely.where(~sure).select("key")
    exact = (
        join_many_to_one(lines, near, "key", "left_semi")
        .distinct()
        .groupBy("key")
        .count()
        .where(F.col("count") >= min_sites)
    )
    return store.keep(likely.where(sure).select("key").unionByName(exact.select("key")), "spread")


def remove_spread_lines(
    documents: DataFrame,
    min_sites: int = MIN_SITES,
    id_column: str = "doc_id",
    text_column: str = "text",
    site_column: str = "source",
    lg_k: int = LG_K,
) -> DataFrame:
    """All rows without the lines that occur on at least `min_sites` distinct sites, plus n_lines
    and n_removed.

    Lines are compared without spaces, tabs and carriage returns at their ends; empty lines stay.
    A null site is a site of its own, the empty one. A null text stays null with no lines; an empty
    one has one empty line. Repeated rows are cleaned alike. Columns named n_lines or n_removed are
    replaced; others are kept. An empty table stays empty.

    Texts cross the network once at most, to meet the keys of their own spread lines.
    """
    store = Store(documents.sparkSession, "lines")
    rows = without(documents, ["n_lines", "n_removed"])
    spread = spread_lines(rows, min_sites, store, site_column, text_column, lg_k)
    text = F.col(f"`{text_column}`")
    k1, k2, gone, cut = fresh(rows, "key_a", "key_b", "gone", "cut")
    keyed = rows.withColumns({k1: F.xxhash64(text), k2: F.xxhash64(f"`{id_column}`", text, F.lit(1))})
    held = keyed.select(k1, k2, F.explode(F.transform(_lines(text), _key)).alias("key"))
    held = join_many_to_one(held.where("key is not null"), spread, "key", "left_semi")
    own = held.groupBy(k1, k2).agg(F.collect_set("key").alias(gone))
    joined = join_many_to_one(keyed, own, [k1, k2], "left", derived=True)
    kept = F.filter(
        _lines(text), lambda line: ~F.coalesce(F.array_contains(F.col(gone), _key(line)), F.lit(False))
    )
    cleaned = joined.withColumn(cut, F.when(F.col(gone).isNotNull(), kept))
    names = [f"`{c}`" if c.lower() != text_column.lower() else
             F.coalesce(F.array_join(cut, "\n"), text).alias(c) for c in rows.columns]
    count = F.coalesce(F.size(_lines(text)), F.lit(0)).cast("long")
    count = F.when(text.isNull(), F.lit(0).cast("long")).otherwise(count)
    return cleaned.select(
        *names,
        count.alias("n_lines"),
        F.when(F.col(cut).isNull(), F.lit(0).cast("long")).otherwise(count - F.size(cut)).alias("n_removed"),
    )
