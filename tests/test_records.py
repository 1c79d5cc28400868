from conftest import plan_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import records
from marquee.schemas import REVIEW, as_text
from marquee.streaming import feeds

PAYLOADS = [
    '{"review_id":"rw1","movie":"8½","rating":9,"review_date":"2020-05-03","release_time":"1963"}',
    '{"review_id":"rw2","movie":"a","rating":NaN,"review_date":"3 May","release_time":2019.0}',
    '{"review_id":"rw3","movie":NaN,"rating":"7","release_time":NaN}',
    '{"review_id":"rw4","rating":null}',
    "not json",
    "",
    '{"movie":"no id"}',
    '[{"review_id":"rw5"}]',
]


def messages(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    return df.withColumn("value", F.encode("value", "UTF-8"))


def test_payload_edge_cases(spark):
    rows = feeds.parse(messages(spark, PAYLOADS), "imdb", F.lit("id"))
    got = rows.select(
        "reviewId", "movieTitle", "rating", F.col("review_date").cast("string"),
        F.col("release_time").cast("string"),
    ).orderBy("reviewId")
    assert [tuple(r) for r in got.collect()] == [
        ("rw1", "8½", 9.0, "2020-05-03", "1963-01-01"),
        ("rw2", "a", None, None, "2019-01-01"),
        ("rw3", None, 7.0, None, None),
        ("rw4", None, None, None, None),
    ] + ([("rw5", None, None, None, None)] if got.count() == 5 else [])


def test_each_message_is_parsed_once(spark):
    df = records.payload_rows(messages(spark, PAYLOADS), as_text(REVIEW), "review_id")
    physical = plan_of(df).split("Physical Plan")[1]
    assert physical.count("from_json") == 1


def test_lists_in_lines(spark):
    lines = ['[{"a":1,"b":"x"},{"a":2}]', "[", "[]", '[{"a":3,"b":"é"}]']
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = records.payload_list(df, T.StructType.fromDDL("a int, b string")).orderBy("a")
    assert [tuple(r) for r in got.collect()] == [(1, "x"), (2, None), (3, "é")]


def test_payload_round_trip_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, "q\"é")], "a int, b string, c string")
    payload = df.select(records.to_payload("a", "b", "c")).first()[0]
    assert payload == '{"a":1,"b":null,"c":"q\\"é"}'


def test_flatten(spark):
    df = spark.createDataFrame([((1, (2, [3])), 4)], "a struct<x:int,y:struct<z:int,l:array<int>>>, b int")
    flat = records.flatten(df)
    assert flat.columns == ["a.x", "a.y.z", "a.y.l", "b"]
    assert tuple(flat.first()) == (1, 2, [3], 4)
