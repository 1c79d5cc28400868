"""URL filter by rules, host word segmentation and naive Bayes (operator 8)."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.columns import fresh, without
from marquee.llm.store import Store
from marquee.operators.joins import join_many_to_one

#: A run of letters in a host is cut into pieces of so many before it is segmented; longer ones are
#: no valid labels. A word has as many letters at most.
PIECE = 63
WORD = PIECE
#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first `://` up to a slash, `?` or `#`, in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for its_host, its_path, said in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == its_host) | F.endswith(host, F.lit("." + its_host))) & F.startswith(path, F.lit(its_path))
        rule = F.when(fits, F.lit(its_host + its_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def visible_text(html: Column) -> Column:
    """A page without scripts, styles, comments, tags and named entities, each of which leaves a
    blank. What is never closed stays."""
    hidden = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[a-z/!?][^>]*>|&[a-z0-9]+;"
    return F.regexp_replace(html, hidden, " ")


def word_counts(texts: DataFrame, column: str) -> DataFrame:
    """(word, n): how often each run of letters a-z occurs in the texts; runs that no label can
    hold are left out."""
    runs = F.regexp_extract_all(F.translate(F.col(column), _UPPER, _LOWER), F.lit("[a-z]+"), F.lit(0))
    words = texts.select(F.explode(runs).alias("word")).where(F.length("word") <= WORD)
    return words.groupBy("word").agg(F.count("*").alias("n"))


def split_hosts(hosts: DataFrame) -> DataFrame:
    """(host, at, piece): the runs of letters of each host, long ones in pieces."""
    runs = F.regexp_extract_all("host", F.lit(rf"[a-z]{{1,{PIECE}}}"), F.lit(0))
    return hosts.select("host", F.posexplode(runs).alias("at", "piece"))


def segment(piece: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest words of a run of letters (Viterbi). An unknown word of n letters counts as
    seen 10 / 10 ** n times. Of equal ones the split with the longer last word is taken."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(piece) + 1):
        options = []
        for begin in range(max(0, end - WORD), end):
            n = known.get((begin, end - begin), 0)
            odds = math.log(n or 10.0) - math.log(total) - (0 if n else (end - begin) * math.log(10))
            options.append((best[begin][0] + odds, -begin))
        score, begin = max(options)
        best.append((score, -begin))
    words, end = [], len(piece)
    while end:
        words.append(piece[best[end][1] : end])
        end = best[end][1]
    return words[::-1]


def _segmented(batches, total: int):
    for batch in batches:
        words = [
            segment(row["piece"], {(k["at"], k["size"]): k["n"] for k in row["known"] if k["n"]}, total)
            for row in batch.to_pylist()
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("piece"), pa.array(words, pa.list_(pa.string()))], ["piece", "words"]
        )


def segmented(pieces: DataFrame, counts: DataFrame, store: Store) -> DataFrame:
    """(piece, words) for distinct pieces, with the words' counts met by a join of all substrings."""
    total = max(1, counts.agg(F.sum("n")).first()[0] or 0)
    size = F.length("piece")
    spans = pieces.select("piece", F.explode(F.sequence(F.lit(0), size - 1)).alias("at"), size.alias("whole")).select(
        "piece", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(WORD), F.col("whole") - F.col("at")))).alias("size")
    )
    spans = spans.withColumn("word", F.substr("piece", F.col("at") + 1, F.col("size")))
    met = join_many_to_one(spans, counts, "word", "left")
    lattice = met.groupBy("piece").agg(F.collect_list(F.struct("at", "size", F.coalesce("n", F.lit(0)).alias("n"))).alias("known"))
    return store.keep(lattice.mapInArrow(partial(_segmented, total=total), "piece string, words array<string>"), "segments")


def path_tokens(path: Column) -> Column:
    """Runs of letters and digits in lower case; numbers are all alike."""
    runs = F.regexp_extract_all(F.translate(path, _UPPER, _LOWER), F.lit(r"[a-z]+|[0-9]+|[^\x00-\x7F]+"), F.lit(0))
    return F.transform(runs, lambda t: F.when(t.rlike("^[0-9]"), F.lit("0")).otherwise(t))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """All rows with host, path, rule, verdict (allow or block), score (above 0 for block) and
    host_words.

    The longest rule that fits a url decides. The others are judged by naive Bayes over the words
    of the host and the tokens of the path, learnt from all urls that a rule decides. Words run
    together in a host are told apart by their frequency in the texts of all pages, without markup.

    A null url, or one without `://`, has an empty host and path and is judged by the prior. Null
    pages teach no words. Without a rule that decides anything both classes are alike, and a score
    of 0 allows. Repeated rows and urls are judged alike, each counts when learning. Columns named
    like the new ones are replaced, others are kept. An empty table stays empty.

    Hosts, paths and pieces are judged once each and joined back, hot ones by split joins.
    """
    store = Store(pages.sparkSession, "urls")
    new = ["host", "path", "rule", "verdict", "score", "host_words"]
    rows = without(pages, new)
    url = F.col(f"`{url_column}`")
    parsed = rows.withColumn("host", host_of(url)).withColumn("path", path_of(url))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    each = store.keep(
        parsed.groupBy("host", "path").agg(F.count("*").alias("n")).withColumn("rule", rule).withColumn("said", said), "urls"
    )
    pages_text = rows.select(visible_text(F.col(f"`{html_column}`")).alias(html_column))
    hosts = _host_words(each.select("host").distinct(), word_counts(pages_text, html_column), store)
    told = each.where("said is not null").withColumn("block", F.when(F.col("said") == "block", F.col("n")).otherwise(0))
    model = store.keep(_learn(told, hosts), "tokens")
    prior = told.agg(F.sum("block").alias("b"), F.sum("n").alias("n")).first()
    bias = math.log(((prior.b or 0) + 1) / ((prior.n or 0) - (prior.b or 0) + 1))
    host_scores = _scores(hosts.select("host", F.explode("words").alias("token")), "host", "h", model)
    path_scores = _scores(
        each.select("path").distinct().select("path", F.explode(path_tokens(F.col("path"))).alias("token")), "path", "p", model
    )
    h, p = fresh(parsed, "host_score", "path_score")
    hosts = hosts.join(host_scores.withColumnRenamed("sum", h), "host", "left")
    judged = join_many_to_one(parsed, hosts.withColumnRenamed("words", "host_words"), "host", "left", derived=True)
    judged = join_many_to_one(judged, path_scores.withColumnRenamed("sum", p), "path", "left", derived=True)
    score = F.lit(bias) + F.coalesce(F.col(h), F.lit(0.0)) + F.coalesce(F.col(p), F.lit(0.0))
    judged = judged.withColumn("score", F.round(score, 9)).withColumn("rule", rule).withColumn(
        "verdict", F.coalesce(said, F.when(F.col("score") > 0, "block").otherwise("allow"))
    )
    return judged.select(*[f"`{c}`" for c in rows.columns], *new)


def _host_words(hosts: DataFrame, counts: DataFrame, store: Store) -> DataFrame:
    """(host, words) in order."""
    pieces = split_hosts(hosts)
    counts = store.keep(counts, "words")
    words = segmented(pieces.select("piece").distinct(), counts, store)
    met = join_many_to_one(pieces, words, "piece")
    in_order = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda x: x["words"]))
    found = met.groupBy("host").agg(in_order.alias("words"))
    empty = F.array().cast("array<string>")
    return store.keep(
        hosts.join(found, "host", "left").select("host", F.coalesce("words", empty).alias("words")), "hosts"
    )


def _learn(told: DataFrame, hosts: DataFrame) -> DataFrame:
    """(space, token, weight): the log odds that a token speaks for blocking, with one added to each
    count; the token null holds those of tokens that were never seen."""
    by_host = told.groupBy("host").agg(F.sum("n").alias("n"), F.sum("block").alias("block"))
    of_hosts = by_host.join(hosts, "host").select(F.lit("h").alias("space"), F.explode("words").alias("token"), "n", "block")
    of_paths = told.select(F.lit("p").alias("space"), F.explode(path_tokens(F.col("path"))).alias("token"), "n", "block")
    counted = of_hosts.unionByName(of_paths).groupBy("space", "token").agg(F.sum("n").alias("n"), F.sum("block").alias("block"))
    whole = counted.groupBy("space").agg(
        F.sum("block").alias("all_block"), F.sum(F.col("n") - F.col("block")).alias("all_allow"), F.count("*").alias("kinds")
    )

    def odds(block: Column, allow: Column) -> Column:
        return F.log((block + 1) / (F.col("all_block") + F.col("kinds") + 1)) - F.log(
            (allow + 1) / (F.col("all_allow") + F.col("kinds") + 1)
        )

    seen = counted.join(F.broadcast(whole), "space")  # two rows
    seen = seen.select("space", "token", odds(F.col("block"), F.col("n") - F.col("block")).alias("weight"))
    return seen.unionByName(
        whole.select("space", F.lit(None).cast("string").alias("token"), odds(F.lit(0), F.lit(0)).alias("weight"))
    )


def _scores(tokens: DataFrame, key: str, space: str, model: DataFrame) -> DataFrame:
    """The sum of the weights of each key's tokens."""
    own = model.where(F.col("space") == space)
    unseen = own.where("token is null").select("weight").first()
    weights = own.where("token is not null").select("token", "weight")
    met = join_many_to_one(tokens, weights, "token", "left")
    weight = F.coalesce("weight", F.lit(unseen.weight if unseen else 0.0))
    return met.groupBy(key).agg(F.sum(weight).alias("sum"))
