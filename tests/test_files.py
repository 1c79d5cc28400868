import json
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.schemas import REVIEW
from marquee.sources import files, lines, sinks, tables

ROWS = [
    ("rw1", 'A "quoted", title', 9.0, "2020-05-03", "2019"),
    ("rw2", "back\\slash", None, None, None),
    ("rw3", " blanks ", 2.5, "", "2019.0"),
    ("rw4", "8½", 1.0, "x", "y"),
]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame(ROWS, REVIEW)
    files.write_csv(df, path)
    df = df.replace("", None)  # CSV does not tell an empty text from a missing one
    assert rows_of(files.read_csv(spark, path, REVIEW)) == rows_of(df)
    some = files.read_csv(spark, path, REVIEW, columns=["rating", "review_id"])
    assert rows_of(some) == rows_of(df.select("rating", "review_id"))


def test_csv_as_other_writers_write_it(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        "review_id,movie,rating,review_date,release_time\n"
        'rw1,"Say ""Hi"", twice",8.0,2020-05-03,2019\n'
        'rw2,"two\nlines",,,\n',
        encoding="utf-8",
    )
    got = files.read_csv(spark, str(path), REVIEW, multi_line=True)
    assert rows_of(got) == [
        ("rw1", 'Say "Hi", twice', 8.0, "2020-05-03", "2019"),
        ("rw2", "two\nlines", None, None, None),
    ]


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text("movie,review_id,rating,review_date,release_time\na,b,1,c,d\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(path), REVIEW).collect()


def test_json_documents(spark, tmp_path):
    nested = {"id": 1, "who": {"name": "a", "at": {"x": 2}}}
    (tmp_path / "one.json").write_text(json.dumps(nested, indent=2))
    (tmp_path / "many.json").write_text(json.dumps([nested, {"id": 3}], indent=2))
    schema = T.StructType.fromDDL("id int, who struct<name:string, at:struct<x:int>>")
    got = files.read_json_flat(spark, str(tmp_path / "*.json"), schema)
    assert got.columns == ["id", "who.name", "who.at.x"]
    assert rows_of(got) == [(1, "a", 2), (1, "a", 2), (3, None, None)]


def test_json_document_files_are_valid_json(spark, tmp_path):
    path = tmp_path / "docs"
    # Copies of one row must not break the brackets.
    df = spark.createDataFrame(ROWS + ROWS + [ROWS[0]] * 20, REVIEW)
    files.write_json_documents(df, str(path), ["review_id"], 3)
    found = [json.loads(p.read_text()) for p in path.glob("part=*/*.txt")]
    assert 1 <= len(found) <= 3
    assert sum(len(f) for f in found) == 28
    got = files.read_json_documents(spark, f"{path}/part=*", REVIEW, partitions=5)
    assert rows_of(got) == rows_of(df)


def test_json_lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    df = spark.createDataFrame(ROWS, REVIEW)
    files.write_json_lines(df, path)
    files.write_json_lines(df, path)
    assert rows_of(files.read_json_lines(spark, path, REVIEW)) == rows_of(df.union(df))


def leading(all_lines, budget, header):
    """Line by line, as a single reader would."""
    kept, used = [], 0
    if header and all_lines:
        kept, all_lines = [all_lines[0]], all_lines[1:]
    for line in all_lines:
        if used + len(line.encode()) > budget:
            break
        used += len(line.encode())
        kept.append(line)
    return [line.rstrip("\n") for line in kept]


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("end", ["", "\n"])
def test_leading_lines_equal_a_single_reader(spark, tmp_path, header, end):
    rng = random.Random(5)
    parts = []
    for part in range(3):
        text = [f"{part}-{i}é" * rng.randint(0, 6) + "\n" for i in range(60)]
        text[-1] = text[-1].rstrip("\n") + "x" + end
        (tmp_path / f"part-{part}.txt").write_text("".join(text), encoding="utf-8")
        parts += text
    total = sum(len(t.encode()) for t in parts)
    head = len(parts[0].encode()) if header else 0
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        edges = [0, 1000, 1777, total - head - 1, total - head, total + 9]
        for budget in edges:
            got = lines.leading_lines(spark, str(tmp_path), budget, header=header)
            got = got.orderBy(*lines.POSITION)
            assert [r.value for r in got.collect()] == leading(parts, budget, header), budget
        assert lines.read_lines(spark, str(tmp_path)).select("file", "block").distinct().count() > 9
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_conform(spark):
    schema = T.StructType.fromDDL("a int, b double, c string, d date")
    df = spark.createDataFrame([("7", "x", 3, "extra")], "a string, b string, c int, e string")
    got = sinks.conform(df, schema)
    assert got.dtypes == [("a", "int"), ("b", "double"), ("c", "string"), ("d", "date")]
    assert tuple(got.first()) == (7, None, "3", None)


def test_table_is_created_once(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = T.StructType.fromDDL("a int")
    sinks.ensure_table(spark, path, schema)
    sinks.append_table(spark.range(3).select(F.col("id").alias("a")), path, schema)
    sinks.ensure_table(spark, path, schema)
    got = spark.read.parquet(path)
    assert got.count() == 3 and got.dtypes == [("a", "int")]


def test_bulk_write_sends_batches_and_raises(spark, tmp_path):
    folder = str(tmp_path)

    def client():
        import json as j
        import uuid

        def send(batch):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                j.dump(batch, f)

        return send

    sinks.bulk_write(spark.range(0, 1000, 1, 4), client, batch_size=100)
    batches = [json.loads(p.read_text()) for p in tmp_path.iterdir()]
    assert sorted(d["id"] for b in batches for d in b) == list(range(1000))
    assert max(len(b) for b in batches) == 100

    def broken():
        def send(batch):
            raise ConnectionError("store is down")

        return send

    with pytest.raises(Exception, match="store is down"):
        sinks.bulk_write(spark.range(10), broken)


def test_spread_leaves_large_tables_alone(spark, sf_dir):
    small = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert tables.spread(small, "doc_id").rdd.getNumPartitions() == 4
    wide = spark.range(0, 100, 1, 9)
    assert tables.spread(wide, "id") is wide


def test_preview(spark):
    df = spark.range(100)
    assert [r.id for r in files.preview(df, 3, [F.desc("id")]).collect()] == [99, 98, 97]
    assert files.preview(df).count() == 5
