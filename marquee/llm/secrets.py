"""Secret scan with multipart credential linking (operator 10); DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.store import Store


@dataclass(frozen=True)
class Kind:
    """A pattern of spans. `base` ones are always reported, others only if linked. `part` is what
    the span contributes to a credential. `value` is a group that needs `least` characters."""

    name: str
    pattern: str
    part: str
    base: bool = False
    value: int = 0
    least: int = 1


#: In the order in which spans with one start are listed. Runs of a class of characters are asked
#: for at their least length at once, which finds the same spans as all runs without the short ones.
KINDS = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        "secret", True, 2, 6,
    ),
    Kind("access", r"AKIA[A-Z0-9]{16,}", "identifier", True),
    Kind("hex", r"[0-9a-f]{24,}", "secret", True),
    Kind(
        "identifier",
        r"""((?i:client_?id|access_?key_?id|user_?name|user|login|account))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.+-]+)""",
        "identifier", False, 2, 3,
    ),
    Kind("token", r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?=[a-z0-9+/_-]*[A-Z])[A-Za-z0-9+/_-]{20,}", "secret"),
    Kind("endpoint", r"""[A-Za-z][A-Za-z0-9+.-]{1,30}://[^\x00-\x20"'<>]+""", "endpoint"),
)
#: What must lie within the scope of a weak part for it to be reported.
NEEDS = {"identifier": ("secret",), "secret": ("identifier",), "endpoint": ("identifier", "secret")}
#: Code points between two parts of one credential, at most.
SCOPE = 200


def _matches(text: Column, kind: Kind) -> Column:
    """Gap before, length and value length of each match, leftmost first, without overlap."""
    pattern = F.lit(kind.pattern)
    # the split gives the text between the matches, in the same order
    gaps = F.split(text, kind.pattern, -1)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(kind.value)) if kind.value else whole
    found = F.transform(
        F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("g"), whole.alias("w"), value.alias("v")),
        lambda m: F.struct(
            F.length(m["g"]).alias("gap"),
            F.length(m["w"]).alias("size"),
            (F.length(m["v"]) >= kind.least).alias("kept"),
        ),
    )
    none = F.array().cast("array<struct<gap:int,size:int,kept:boolean>>")
    return F.when(text.rlike(kind.pattern), found).otherwise(none)


def find_parts(documents: DataFrame, store: Store) -> tuple[DataFrame, DataFrame]:
    """A written row for each document (row, doc_id, found), and a row for each part:
    row, kind (its place in KINDS), start, stop in code points."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.array(*[_matches(text, kind) for kind in KINDS])
    docs = store.keep(
        documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", found.alias("found")),
        "matches",
    )
    each = docs.select("row", F.posexplode("found").alias("kind", "m")).select(
        "row", "kind", F.posexplode("m").alias("i", "m")
    )
    upto = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("stop", F.sum(F.col("m.gap") + F.col("m.size")).over(upto))
    parts = placed.where("m.kept").select("row", "kind", (F.col("stop") - F.col("m.size")).alias("start"), "stop")
    return docs, store.keep(parts, "parts")


def _is(*parts: str, base: bool | None = None) -> Column:
    chosen = [i for i, k in enumerate(KINDS) if k.part in parts and (base is None or k.base == base)]
    return F.col("kind").isin(chosen)


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts whose complements lie within `scope` code points of them in their document.

    An interval join in cells of `scope` code points: of each cell and sort of part only the first
    start and the last stop matter to whoever looks in from a neighbouring cell, and a part within
    a cell of the looker's interval is in reach anyway. So no pairs of parts are made.
    """
    sort = reduce(
        lambda other, p: F.when(_is(p), F.lit(p)).otherwise(other), NEEDS, F.lit(None).cast("string")
    )
    cells = (
        parts.withColumn("part", sort)
        .withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("stop") / scope))))
        .groupBy("row", "cell", "part")
        .agg(F.min("start").alias("first_start"), F.max("stop").alias("last_stop"))
    )
    weak = parts.where(_is(*NEEDS, base=False)).withColumn(
        "cell",
        F.explode(
            F.sequence(
                F.floor((F.col("start") - scope) / scope), F.floor((F.col("stop") + scope) / scope)
            )
        ),
    )
    near = weak.join(cells, ["row", "cell"]).where(
        (F.col("first_start") <= F.col("stop") + scope) & (F.col("last_stop") >= F.col("start") - scope)
    )
    seen = near.groupBy("row", "kind", "start", "stop").agg(
        *[F.bool_or(F.col("part") == p).alias(f"has_{p}") for p in NEEDS]
    )
    complete = reduce(
        lambda x, y: x | y,
        [_is(p) & reduce(lambda x, y: x & y, [F.col(f"has_{q}") for q in need]) for p, need in NEEDS.items()],
    )
    return seen.where(complete).select("row", "kind", "start", "stop")


def scan_secrets(
    documents: DataFrame, scope: int = SCOPE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """A row for each document with its spans, in code points: doc_id and spans, an array of
    (start, place, kind, stop, base) in order; `place` is the kind's place in KINDS.

    Passwords and tokens that are assigned, access keys and long hexadecimal runs are always
    reported. Account names, mixed tokens and endpoints are weak: they are reported if what would
    complete a credential lies within `scope` code points: a secret for an identifier, an
    identifier for a secret, both for an endpoint.

    Null and empty texts have no spans. Each row is scanned on its own, so repeated rows and null
    ids give rows of their own. Texts of any length are scanned whole. Other columns are ignored;
    an empty table gives no rows.

    Matches are found by the engine's regular expressions; their positions are running sums over
    the texts between them. Only matches, no texts, are shuffled.
    """
    store = Store(documents.sparkSession, "secrets")
    docs, parts = find_parts(
        documents.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")), store
    )
    base = F.col("kind").isin([i for i, k in enumerate(KINDS) if k.base])
    reported = parts.where(base).withColumn("base", F.lit(True)).unionByName(
        linked(parts, scope).withColumn("base", F.lit(False))
    )
    names = F.array(*[F.lit(k.name) for k in KINDS])
    spans = reported.groupBy("row").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "start", F.col("kind").alias("place"), F.element_at(names, F.col("kind") + 1).alias("kind"),
                    "stop", "base",
                )
            )
        ).alias("spans")
    )
    none = F.array().cast("array<struct<start:bigint,place:int,kind:string,stop:bigint,base:boolean>>")
    return (
        docs.select("row", "doc_id").join(spans, "row", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
    )
