import math
import random
import re
from collections import Counter
from hashlib import sha256
from zlib import crc32

import pytest

from marquee.llm import resampling
from marquee.llm.resampling import Gains, features, noise, resample, words_of

SCHEMA = "doc_id long, text string, _id string, Score string, _block int"
WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain(text):
    """Runs of one to three words by their text."""
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORDS.findall(lower)
    return len(words), [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, target, buckets, least, share):
    hashed = lambda f: crc32(f.encode()) % buckets
    s = Counter(hashed(f) for _, text in docs for f in plain(text)[1])
    t = Counter(hashed(f) for text in target for f in plain(text)[1])
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
        for b in range(buckets)
    }
    out = []
    for i, text in docs:
        n, runs = plain(text)
        weight = sum(gain[hashed(f)] for f in runs)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    drawable = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for place, row in enumerate(drawable[: len(drawable) * share[0] // share[1]]):
        row[5] = place + 1
    return out


def order(row):
    return [(v is not None, v or 0) for v in row]


def test_words_and_features():
    texts = ["Ab-C9 éÉ  ÀB\nx", "", "one", "ß漢 字z", "\x7f\x00A", "ſK a"]
    for text in texts:
        n, runs = plain(text)
        words = words_of(text.encode())
        assert len(words) == n and [w.decode() for w in words] == runs[:n]
        assert Counter(features(words)) == Counter(crc32(f.encode()) for f in runs)


def test_chunks_leave_no_run_out(monkeypatch):
    words = [b"w%d" % (i % 7) for i in range(50)]
    for size in (1, 2, 3, 7, 24, 48, 49, 50, 51):
        monkeypatch.setattr(resampling, "CHUNK_WORDS", size)
        for n in (0, 1, 2, 3, size, size + 1, size + 2, 50):
            got = Counter(f for part in resampling._chunks(words[:n]) for f in part)
            assert got == Counter(features(words[:n]))


@pytest.mark.parametrize("share", [(5, 100), (1, 2), (1, 1), (0, 100)])
def test_against_brute_force(spark, share):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["Zé", "漢字", "A1"]
    docs = [(i, " ".join(r.choices(vocabulary, k=r.randrange(60)))) for i in range(200)]
    docs += [(i, docs[3][1]) for i in range(200, 320)]  # many copies
    docs += [docs[7], docs[7], docs[7], (None, docs[7][1]), (400, None), (401, ""), (402, "!?"), (403, "long w1 " * 90000)]
    target = [" ".join(r.choices(vocabulary[:9], k=30)) for _ in range(20)] + [None, ""]
    frame = spark.createDataFrame([(i, t, "x", "old", 3) for i, t in docs], SCHEMA)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample(frame, wanted, share=share, buckets=97)
    assert got.columns == ["doc_id", "text", "_id", "_block", "n_words", "n_features", "weight", "score", "rank"]
    rows = [list(x) for x in got.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    assert sorted(rows, key=order) == sorted(brute(docs, target, 97, 20, share), key=order)
    again = resample(frame.repartition(7), wanted, share=share, buckets=97, carry=["doc_id"])
    assert sorted(map(list, again.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=order) == sorted(rows, key=order)


def test_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b c", "", "", 0), (2, None, "", "", 0)], SCHEMA)
    nothing = spark.createDataFrame([], "text string")
    assert resample(frame.limit(0), nothing).collect() == []
    got = {x.doc_id: x for x in resample(frame, nothing, share=(1, 1), least_words=3).collect()}
    assert got[1].rank == 1 and got[2].rank is None and got[2].weight == 0 and got[2].score == noise(42, 2)


def test_drawn_in_proportion_to_the_ratio():
    """Over many seeds the first of two rows is drawn as often as exp of its weight says."""
    weights = {1: 1000, 2: 0}
    first = sum(1000 + noise(s, 1) > noise(s, 2) for s in range(4000)) / 4000
    assert weights[1] == 1000 and first == pytest.approx(math.e / (1 + math.e), abs=0.03)


def test_gains_of_nothing():
    assert set(Gains.of({}, {}, 5).by_bucket.tolist()) == {0}
