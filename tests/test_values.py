import datetime as dt

from pyspark.sql import functions as F

from marquee.functions import values
from marquee.operators import columns


def one(spark, expression, samples, kind="string"):
    df = spark.createDataFrame([(s,) for s in samples], f"c {kind}")
    return [r[0] for r in df.select(expression(F.col("c"))).collect()]


def test_dates_are_reformatted_or_left(spark):
    expected = {
        "3 May 2020": "2020-05-03",
        "03 May 2020": "2020-05-03",
        "3 MAY 2020": "2020-05-03",
        " 3 May 2020": "2020-05-03",
        "3  May 2020": "2020-05-03",
        "3 May 2020 ": "3 May 2020 ",
        "2020-05-03": "2020-05-03",
        "31 February 2020": "31 February 2020",
        "3 May 20": "3 May 20",
        "": "",
    }
    assert one(spark, values.reformat_date, expected) == list(expected.values())
    assert one(spark, values.reformat_date, [None]) == [None]


def test_years(spark):
    samples = ["2019", "2019.0", "NaN", "", "20190", "0", "abc", None]
    first = dt.date(2019, 1, 1)
    assert one(spark, values.year_start, samples) == [first, first] + [None] * 6
    assert one(spark, values.to_int, ["2019.0", "7", "x", "1e300"]) == [2019, 7, None, None]


def test_iso_dates_do_not_fail(spark):
    got = one(spark, values.iso_date, ["2020-05-03", "2020-02-31", "May", None])
    assert got == [dt.date(2020, 5, 3), None, None, None]
    assert one(spark, values.iso_text, [dt.date(2020, 5, 3), None], "date") == ["2020-05-03", None]


def test_numbers_and_missing_spellings(spark):
    samples = ["1.5", "NaN", "", "x", None]
    assert one(spark, values.to_double, samples) == [1.5, None, None, None, None]
    assert one(spark, values.half_scale, ["9", "x"]) == [4.5, None]
    texts = ["a", "NaN", "", "None", '"NaN"', None]
    assert one(spark, values.present, texts) == ["a", "NaN", "", "None", None, None]
    assert one(spark, values.finite, [float("nan"), 2.0], "double") == [None, 2.0]


def test_ids(spark):
    df = spark.createDataFrame([("t", 0, 1), ("t", 0, 2), ("t", 0, 1)], "a string, b int, c int")
    same = [r[0] for r in df.select(values.stable_id(*[F.col(c) for c in "abc"])).collect()]
    assert same[0] == same[2] != same[1]
    fresh = [r[0] for r in df.select(values.random_id()).collect()]
    assert len(set(fresh)) == 3
    assert len(df.select(values.now_text()).first()[0]) == 19


def test_columns_by_name(spark):
    df = spark.createDataFrame([("1.5", "x", "NaN")], "a string, b string, c string")
    got = columns.cast_columns(df, ["a", "c"])
    assert got.dtypes == [("a", "double"), ("b", "string"), ("c", "double")]
    assert tuple(got.first()) == (1.5, "x", None)
    assert columns.exclude(df, ["b", "no such"]).columns == ["a", "c"]
    assert columns.keep(df, ["c", "a"]).columns == ["c", "a"]
    assert columns.rename(df, {"a": "z"}).columns == ["z", "b", "c"]


def test_substring_of_the_review_id_is_one_user(spark):
    ids = [f"rw{n}" for n in range(5704482, 5704522)]
    got = one(spark, lambda c: F.substring(c, 3, 2).try_cast("int"), ids)
    assert set(got) == {57}
