import hashlib
import random
from collections import defaultdict

import pytest

from marquee.llm import sharding
from marquee.llm.sharding import ROW_BYTES, shard_by_bytes

SCHEMA = "doc_id long, text string, SHARD string, part int, nth int, key_a string"


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def brute(rows, shards):
    """Each key goes to the shard that its middle byte falls into."""
    sizes = defaultdict(int)
    keys = [(number(t or ""), number("" if d is None else str(d))) for d, t in rows]
    for key, (_, text) in zip(keys, rows, strict=True):
        sizes[key] += len((text or "").encode()) + ROW_BYTES
    total, below, shard = sum(sizes.values()), 0, {}
    for key in sorted(sizes):
        shard[key] = min(shards - 1, (2 * below + sizes[key]) * shards // (2 * total))
        below += sizes[key]
    return sorted(((d, t, shard[k]) for k, (d, t) in zip(keys, rows, strict=True)), key=str)


@pytest.mark.parametrize("shards,slot_rows", [(1, 1 << 20), (7, 1 << 20), (7, 16), (300, 8)])
def test_against_brute_force(spark, monkeypatch, shards, slot_rows):
    monkeypatch.setattr(sharding, "SLOT_ROWS", slot_rows)
    r = random.Random(2)
    rows = [(i, "é" * r.randint(0, 400)) for i in range(120)]
    rows += [(i, "the same text") for i in range(200, 330)]
    rows += [(500, "again")] * 9 + [(None, "again"), (None, None), (1, None), (2, ""), (3, "x" * 20000)]
    df = spark.createDataFrame([(d, t, "old", 1, 2, "k") for d, t in rows], SCHEMA)
    got = shard_by_bytes(df, shards)
    assert got.columns == ["doc_id", "text", "part", "nth", "key_a", "shard", "slot"]
    got = got.collect()
    assert sorted(((g.doc_id, g.text, g.shard) for g in got), key=str) == brute(rows, shards)
    slots = defaultdict(list)
    for g in got:
        slots[g.shard].append(g.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table_and_tolerance(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert shard_by_bytes(df).collect() == []
    rows = [(i, "x" * (i % 50)) for i in range(2000)]
    df = spark.createDataFrame([(d, t, "old", 1, 2, "k") for d, t in rows], SCHEMA)
    sizes = defaultdict(int)
    for g in shard_by_bytes(df, 4, tolerance=0.05).collect():
        sizes[g.shard] += len(g.text) + ROW_BYTES
    mean = sum(sizes.values()) / 4
    assert all(abs(s - mean) <= 0.11 * mean for s in sizes.values())


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = shard_by_bytes(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
