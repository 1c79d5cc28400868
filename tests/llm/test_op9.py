import random

import numpy as np
import pyarrow as pa
import pytest

from marquee.llm import decontaminate
from marquee.llm.decontaminate import GAP, LIMIT, MATCH, MISMATCH, Items, align, find_leaks
from marquee.llm.words import words_of

SCHEMA = "doc_id long, text string, leaks string, item_id int, gram string"


def smith_waterman(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            s = MATCH if a[i] == b[j] else -MISMATCH
            h[i + 1, j + 1] = max(0, h[i, j] + s, h[i, j + 1] - GAP, h[i + 1, j] - GAP)
    return h.max()


def test_alignment_against_the_full_table():
    r = np.random.default_rng(7)
    for _ in range(60):
        a, b = r.integers(0, 5, r.integers(1, 15)), r.integers(0, 5, r.integers(1, 25))
        score, first, last = align(a.astype(np.uint64), b.astype(np.uint64))
        assert score == smith_waterman(a, b)
        if score:
            assert smith_waterman(a, b[first : last + 1]) == score


def words(text):
    return next(iter(words_of(pa.array([text])))).hashes


def edited(r, text, share):
    out = []
    for w in text.split():
        kind = r.random()
        if kind < share / 3:
            continue
        out.append("zz" if kind < share * 2 / 3 else w)
        if share * 2 / 3 <= kind < share:
            out.append("yy")
    return " ".join(out)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 400])
def test_planted_copies(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    r = random.Random(0)
    vocabulary = [f"v{i}" for i in range(80)]

    def prose(n):
        return " ".join(r.choice(vocabulary) for _ in range(n))

    items = [(i, prose(r.randint(15, 50))) for i in range(12)] + [(50, "v1 v2 v3"), (51, "v9"), (52, None), (53, " "), (None, "u1 u2 u3 u4")]
    docs, want = [], set()
    for k in range(60):
        item, text = items[k % 12]
        if k < 36:
            copy = text.upper() if k < 12 else edited(r, text, 0.05 if k < 24 else 0.25)
            docs.append((k, prose(200) + " " + copy + "\n" + prose(300)))
            want.add((k, item))
        else:
            docs.append((k, prose(400)))
    docs += [(70, None), (71, ""), (72, "v1"), (73, "a U1 u2\tu3 u4 b"), (73, "a U1 u2\tu3 u4 b"), (None, items[0][1]), (74, prose(30000) + items[1][1])]
    want |= {(73, None), (None, 0), (74, 1)}
    df = spark.createDataFrame([(d, t, "old", 1, "g") for d, t in docs], SCHEMA)
    got = find_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(got.columns) == sorted(df.columns)
    rows = got.collect()
    assert len(rows) == len(docs)
    long_items = {i for i, t in items if t and len(t.split()) >= 4}
    found = {(g.doc_id, x.item_id) for g in rows for x in g.leaks if x.item_id in long_items}
    assert found == want
    # every match is one: its passage aligns that well
    texts = {d: t for d, t in docs}
    item_texts = dict(items)
    for g in rows:
        for x in g.leaks:
            passage = texts[g.doc_id].split()[x.first_word : x.last_word + 1]
            item = words(item_texts[x.item_id])
            assert x.score == smith_waterman(item, words(" ".join(passage))) and x.ratio >= LIMIT


@pytest.mark.parametrize("hits", [decontaminate.HITS, 1])
def test_only_copy_is_edited(spark, monkeypatch, hits):
    """The n-grams that the edits break occur nowhere; what is left must find the copy."""
    monkeypatch.setattr(decontaminate, "HITS", hits)
    items = [(k, " ".join(f"i{k}w{j}" for j in range(n))) for k, n in enumerate([40] * 4 + [15, 59])]
    docs = []
    for k, text in items:
        copy = [f"e{k}x{j}" if j % 4 == k % 4 else w for j, w in enumerate(text.split())]
        docs.append((k, " ".join([f"a{j}" for j in range(100)] + copy + [f"b{j}" for j in range(100)]), "old", 1, "g"))
    # one run of three words, a word put in after each of the others
    text = "t0 " + " ".join(f"t{j}" + (f" n{j}" if j < 26 else "") for j in range(1, 30))
    items.append((9, " ".join(f"t{j}" for j in range(30))))
    docs.append((9, text, "old", 1, "g"))
    got = find_leaks(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert {(g.doc_id, x.item_id) for g in got.collect() for x in g.leaks} == {(k, k) for k, _ in items}


def test_items_of_one_and_two_words(spark):
    items = [(1, "Word"), (2, "two words"), (3, "one two three"), (4, "absent"), (5, "words two")]
    docs = [
        (1, "a WORD in a long text"), (2, "here are two\nwords and more"), (3, "two other words"), (4, "word"),
        (5, "two words"), (6, "one two three four"), (7, "ends with two"), (8, "words begin here"), (9, "password"),
    ]
    df = spark.createDataFrame([(d, t, "old", 1, "g") for d, t in docs], SCHEMA).coalesce(1)
    got = find_leaks(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(g.doc_id, x.item_id) for g in got for x in g.leaks} == {(1, 1), (2, 2), (4, 1), (5, 2), (6, 3)}
    (word,) = got[0].leaks
    assert (word.first_word, word.last_word, word.ratio) == (1, 1, 1.0)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(df, items).collect() == []
    one = spark.createDataFrame([(1, "a b c", "x", 1, "g")], SCHEMA)
    assert [g.leaks for g in find_leaks(one, items).collect()] == [[]]


def substituted(r, text, share):
    return " ".join(f"s{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def test_recall_of_rare_seeds():
    """Of single copies with edits that still reach the limit, rare seeds lose under one in a hundred."""
    r = random.Random(11)
    vocabulary = [f"v{i}" for i in range(300)]
    items = [" ".join(r.choice(vocabulary) for _ in range(r.randint(15, 59))) for _ in range(150)]
    prose = [" ".join(r.choice(vocabulary) for _ in range(400)) for _ in range(200)]
    grams = Items.of(list(range(len(items))), [words(t) for t in items])
    for share in (0.2, 0.25, 0.3):
        copies = [substituted(r, t, share) for t in items]
        texts = [f"{prose[i % 200]} {c} {prose[(i + 1) % 200]}" for i, c in enumerate(copies)]
        counts = np.zeros(len(grams.seeds.values), np.int64)
        for w in words_of(pa.array(texts + prose)):
            counts += np.bincount(decontaminate._hits(w, grams)[1], minlength=len(counts))
        rare = grams.rare(counts)
        assert len(rare.owner) < 0.7 * len(grams.owner)
        due = lost = 0
        for i, text in enumerate(texts):
            if smith_waterman(words(items[i]), words(copies[i])) >= LIMIT * MATCH * len(items[i].split()):
                due += 1
                found = decontaminate._matches(next(iter(words_of(pa.array([text])))), rare)
                lost += i not in {x["item_id"] for x in found.get(0, [])}
        assert due > 50 and lost <= 0.01 * due


def test_a_shared_phrase_costs_nothing():
    """Documents that say what many items begin with are not brought together with all of them."""
    phrase = "which of the following is"
    docs = [f"a{i} b{i} {phrase} c{i} d{i}" for i in range(20)]
    pairs = {}
    for n in (100, 2000):
        ids, texts = list(range(n)), [f"{phrase} " + " ".join(f"q{i}w{j}" for j in range(15)) for i in range(n)]
        items = Items.of(ids, [words(t) for t in texts])
        chunk = next(iter(words_of(pa.array([*docs, texts[7]]))))
        counts = np.bincount(decontaminate._hits(chunk, items)[1], minlength=len(items.seeds.values))
        rare = items.rare(counts)
        at, place, _ = decontaminate._hits(chunk, rare)
        pairs[n] = int((rare.first[place + 1] - rare.first[place]).sum())
        assert {r: [x["item_id"] for x in m] for r, m in decontaminate._matches(chunk, rare).items()} == {20: [7]}
    assert pairs[100] == pairs[2000]


def test_equal_items_are_found_under_each_id(spark):
    text = " ".join(f"w{j}" for j in range(12))
    items = spark.createDataFrame([(i, text) for i in range(50)], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"x {text} y", "", 0, ""), (2, "nothing", "", 0, "")], SCHEMA)
    got = {g.doc_id: sorted(x.item_id for x in g.leaks) for g in find_leaks(docs, items).collect()}
    assert got == {1: list(range(50)), 2: []}
