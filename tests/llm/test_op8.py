import math
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm.urls import RULES, filter_urls, host_of, path_of, rule_of, segment, visible_text, word_counts

SCHEMA = "page_id long, url string, html string, host string, rule int, token string"


@pytest.mark.parametrize(
    "url,host,path,rule",
    [
        ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/"),
        ("https://example.net/EN/", "example.net", "/EN/", "net/"),
        ("x://net", "net", "", None),
        ("x://net/", "net", "/", "net/"),
        ("a://b://c/d", "b:", "//c/d", None),
        ("http://www.example.com/de/#x", "www.example.com", "/de/", "example.com/de/"),
        ("http://badexample.com/de/", "badexample.com", "/de/", None),
        ("http://x.org/fr/?", "x.org", "/fr/", "org/fr/"),
        ("http://É.org?a/fr/", "É.org", "", None),
        ("no scheme", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
        ("http://a\nb.net/\n/c", "a\nb.net", "/\n/c", "net/"),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule):
    df = spark.createDataFrame([(url,)], "url string").select(host_of(F.col("url")).alias("h"), path_of(F.col("url")).alias("p"))
    got = df.withColumn("r", rule_of(F.col("h"), F.col("p"), RULES)[0]).first()
    assert tuple(got) == (host, path, rule)


def brute_segment(piece, counts, total):
    def odds(word):
        n = counts.get(word)
        return math.log(n / total) if n else math.log(10 / total) - len(word) * math.log(10)

    def splits(text):
        if not text:
            yield []
        for i in range(1, len(text) + 1):
            for rest in splits(text[i:]):
                yield [text[:i], *rest]

    return max(sum(map(odds, s)) for s in splits(piece)), odds


def test_segment_against_all_splits():
    r = random.Random(4)
    counts = {"".join(r.choice("ab") for _ in range(r.randint(1, 4))): r.randint(1, 50) for _ in range(12)}
    total = sum(counts.values())
    for _ in range(30):
        piece = "".join(r.choice("abc") for _ in range(r.randint(1, 9)))
        known = {(i, j - i): counts[piece[i:j]] for i in range(len(piece)) for j in range(i + 1, len(piece) + 1) if piece[i:j] in counts}
        best, odds = brute_segment(piece, counts, total)
        words = segment(piece, known, total)
        assert "".join(words) == piece and sum(map(odds, words)) == pytest.approx(best)


def test_words_decide_the_rest(spark):
    text = "free money casino news green garden " * 50
    rows = [(i, f"http://free{'money' if i % 2 else 'casino'}.net/win/{i}", text, "x", 1, "t") for i in range(20)]
    rows += [(100 + i, f"http://green{'garden' if i % 2 else 'news'}.org/fr/{i}", text, "x", 1, "t") for i in range(20)]
    rows += [(200, "http://casinomoney.example.com/win/1", None, None, None, None), (201, "http://gardennews.com/fr/2", "", "", 0, "")]
    rows += [(None, None, None, None, None, None), (300, "", "", "", 0, ""), (301, "http://" + "q" * 5000 + "/x", "", "", 0, "")]
    rows += [rows[0], rows[0], (302, "http://123.45/", "<p>", "", 0, "")]
    got = filter_urls(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["page_id", "url", "html", "token", "host", "path", "rule", "verdict", "score", "host_words"]
    found = {g.page_id: g for g in got.collect()}
    assert got.count() == len(rows)
    assert found[0].rule == "net/" and found[0].verdict == "block" and found[100].verdict == "allow"
    assert found[200].host_words[:2] == ["casino", "money"] and found[200].verdict == "block" and found[200].rule is None
    assert found[201].host_words[:2] == ["garden", "news"] and found[201].verdict == "allow"
    assert found[None].host == "" and found[None].verdict in ("allow", "block")


def test_empty_table_and_no_rules(spark):
    assert filter_urls(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "http://a.b/c", "text", "", 0, "")], SCHEMA)
    assert [g.verdict for g in filter_urls(df, rules=()).collect()] == ["allow"]


def test_long_words_stay_whole(spark):
    long, longest = "rechtsschutzversicherungen", "x" * 31 + "y" * 32
    html = f"<p>{long} rechts schutz {long} {longest} die</p> " * 30
    urls = [f"http://die{long}.example/a", f"http://{longest}.example/b"]
    df = spark.createDataFrame([(i, url, html, "h", 1, "t") for i, url in enumerate(urls)], SCHEMA)
    got = {g.page_id: list(g.host_words) for g in filter_urls(df).collect()}
    assert got[0][:2] == ["die", long] and got[1][0] == longest


def test_markup_teaches_no_words(spark):
    html = (
        "<!DOCTYPE html><div class='wide'>Plain&nbsp;text<br/>more <!-- remark > here --><SCRIPT src=x>var code = 1 < 2;</Script >"
        "<style>body {}</style>a < b, <p title=\"t\">end</p> <never closed"
    )
    df = spark.createDataFrame([(html,), (None,), ("",)], "html string")
    texts = df.select(visible_text(F.col("html")).alias("html"))
    got = {r.word: r.n for r in word_counts(texts, "html").collect()}
    assert got == dict.fromkeys(["plain", "text", "more", "a", "b", "end", "never", "closed"], 1)
