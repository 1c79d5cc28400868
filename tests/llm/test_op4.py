import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.llm.lines import remove_spread_lines

SCHEMA = "doc_id long, text string, source string, key string, n_lines string, cut int"


def brute(rows, least):
    sites = defaultdict(set)
    for _, text, source in rows:
        for line in (text or "").split("\n") if text is not None else []:
            sites[line.strip(" \t\r")].add(source or "")
    gone = {line for line, own in sites.items() if line and len(own) >= least}
    out = []
    for doc_id, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if x.strip(" \t\r") not in gone]
        out.append((doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("least,lg_k", [(3, 8), (40, 4), (40, 8)])
def test_against_brute_force(spark, least, lg_k):
    """Forty sites and sketches of 16 registers put many lines near the threshold."""
    r = random.Random(1)
    rows = []
    for i in range(300):
        lines = [f"own {i}"] + [f"line {j}" for j in range(60) if r.random() < j / 60] + ["  common\t"] * 2
        rows.append((i, "\n".join(lines), f"s{i % 45}"))
    rows += [(1, None, "s1"), (2, "", "s1"), (3, "\n\n", None), (4, "common\r\nrest", None), (4, "common\r\nrest", None)]
    rows += [(None, "common", "s0"), (5, "common\n" * 4000, "s3")]
    df = spark.createDataFrame([(*row, "k", "old", 0) for row in rows], SCHEMA)
    got = remove_spread_lines(df, least, lg_k=lg_k)
    assert sorted(got.columns) == sorted([*df.columns, "n_removed"])
    got = got.select("doc_id", "text", "n_lines", "n_removed")
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, least)


def test_empty_table(spark):
    assert remove_spread_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = remove_spread_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert docs.select(F.col("text")).count() > 0


def test_twenty_copies_where_one_source_holds_a_third(spark):
    r = random.Random(8)
    rows = []
    for k in range(40):
        for i in range(20):
            site = "hot" if r.random() < 1 / 3 else f"s{r.randrange(19)}"
            rows.append((100 * k + i, f"own {k} {i}\npassage {k} " + "word " * 50, site))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    left = remove_spread_lines(docs).select("text").collect()
    assert len(left) == 800 and all(row.text.startswith("own") and "passage" not in row.text for row in left)
