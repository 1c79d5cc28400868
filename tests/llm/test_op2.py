import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.llm.mixing import corpus_levels, mix

WORD = re.compile("[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, epoch string, passes int, tokens long"
WEIGHTS = {"lang": {"en": 3.0, "de": 1.0, "zz": 0.0}, "source": {"a": 2.0}}


def levels():
    return {"lang": F.col("lang"), "source": F.col("source")}


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(budget, children):
    """children: name -> (weight, cap)"""
    open_, out = dict(children), {}
    while open_:
        total = sum(w for w, _ in open_.values())
        if total <= 0:
            return out | dict.fromkeys(open_, 0.0)
        full = {k: c for k, (w, c) in open_.items() if c <= budget * w / total}
        if not full:
            return out | {k: budget * w / total for k, (w, _) in open_.items()}
        for k, c in full.items():
            out[k] = c
            budget -= c
            del open_[k]
    return out


def brute(rows, budget, epochs, seed):
    leaves = defaultdict(lambda: defaultdict(list))
    for doc_id, text, lang, source in rows:
        size = len(WORD.findall(text or ""))
        key = hashlib.md5(f"{'' if doc_id is None else doc_id}:{text or ''}".encode()).hexdigest()
        leaves[lang or ""][source or ""].append((key, size, doc_id))
    cap = {k: {s: epochs * sum(x[1] for x in own) for s, own in v.items()} for k, v in leaves.items()}
    whole = min(budget, sum(sum(v.values()) for v in cap.values()))
    out = []
    for lang, own in fill(whole, {k: (WEIGHTS["lang"].get(k, 1), sum(v.values())) for k, v in cap.items()}).items():
        shares = fill(own, {s: (WEIGHTS["source"].get(s, 1), c) for s, c in cap[lang].items()})
        for source, share in shares.items():
            docs = leaves[lang][source]
            size, share = sum(d[1] for d in docs), int(share)
            passes = share // size if size else 0
            rest = share - passes * size
            blocks = defaultdict(list)
            for key, tokens, doc_id in docs:
                blocks[number(f"{seed}:{passes}:{key}")].append((tokens, doc_id))
            for e in range(passes):
                out += [(d[2], e) for d in docs]
            for _, block in sorted(blocks.items()):
                if sum(b[0] for b in block) > rest:
                    break
                rest -= sum(b[0] for b in block)
                out += [(b[1], passes) for b in block]
    return sorted(out, key=str)


@pytest.mark.parametrize("budget,epochs", [(300, 1), (2000, 3), (10**9, 2), (0, 2)])
def test_against_brute_force(spark, budget, epochs):
    r = random.Random(budget)
    rows = [(i, "w " * r.randint(1, 30), r.choice(["en", "de", "de", "fr", "zz"]), r.choice("aaaaaabc")) for i in range(120)]
    rows += [(500, "w " * 3000, "fr", "b"), (3, rows[3][1], *rows[3][2:]), (7, "x y", None, None), (None, "x", "en", None)]
    rows += [(8, None, "en", "a"), (9, "", "es", "a"), (10, "", "es", "a")]
    df = spark.createDataFrame([(*row, "old", 1, 2) for row in rows], SCHEMA)
    got = mix(df, WEIGHTS, budget, levels(), epochs, seed=5)
    assert sorted(got.columns) == sorted(df.columns)
    assert sorted(((g.doc_id, g.epoch) for g in got.collect()), key=str) == brute(rows, budget, epochs, 5)


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mix(df, WEIGHTS, 100, levels()).collect() == []


def test_corpus_levels(spark):
    rows = spark.createDataFrame([("src5", "en"), (None, None), ("other", "de")], "source string, lang string")
    domain = corpus_levels()["domain"]
    assert [x[0] for x in rows.select(domain).collect()] == ["news", "web", "web"]
