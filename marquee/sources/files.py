"""CSV and JSON files, read with declared schemas and written in the same dialect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import records
from marquee.sources import ranges

# Quotes are doubled inside quoted fields, as common CSV writers do; Spark's default escape is a
# backslash, which misreads such titles.
_CSV = {"header": "true", "escape": '"', "quote": '"'}
# Blanks around a value are part of it. An empty string is read back as null.
_CSV_WRITE = {**_CSV, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    multi_line: bool = False,
    mode: str = "FAILFAST",
) -> DataFrame:
    """CSV with a header line. Input partitions take the place of chunks. A malformed row fails the
    job; `mode` may ask for something else.

    `columns` reaches the parser: fields that are not selected are not converted. With
    `multi_line`, quoted fields may hold line ends; large files are still read by many tasks, and
    twice.
    """
    if multi_line:
        df = _csv_records(spark, path, schema, mode)
        return df if columns is None else df.select(*columns)
    df = (
        spark.read.schema(schema)
        .options(**_CSV)
        .option("mode", mode)
        # Compare header names with the schema instead of trusting positions.
        .option("enforceSchema", "false")
        .csv(path)
    )
    return df if columns is None else df.select(*columns)


def _ddl(schema: T.StructType) -> str:
    quoted = ("`" + f.name.replace("`", "``") + "` " + f.dataType.simpleString() for f in schema)
    return ", ".join(quoted)


def _parsed(records: DataFrame, parse, schema: T.StructType, mode: str) -> DataFrame:
    """Texts of records (`value`) as rows of the schema. `parse` takes schema and options."""
    if mode != "DROPMALFORMED":
        return records.select(parse(schema, {"mode": mode}).alias("row")).select("row.*")
    bad = "_malformed"
    while bad in schema.fieldNames():
        bad = f"_{bad}"
    wider = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    rows = records.select(parse(wider, options).alias("row")).select("row.*")
    return rows.where(F.col(f"`{bad}`").isNull()).drop(bad)


def _csv_records(
    spark: SparkSession, path: str | list[str], schema: T.StructType, mode: str
) -> DataFrame:
    def parse(wanted: T.StructType, options: dict) -> Column:
        return F.from_csv("value", _ddl(wanted), {**_CSV, "header": "false", "multiLine": "true", **options})

    records = ranges.read_records(spark, path, ranges.Quoted())
    line_end = F.regexp_replace("value", "\r?\n$", "")
    records = records.withColumn("value", line_end)
    # The first record of each file has the names. There is one for each file.
    names = [f.name.lower() for f in schema]
    numbers = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    heads = records.where("record = 0").select("value", parse(numbers, {"mode": "PERMISSIVE"}).alias("h"))
    found = F.transform(F.array(*[F.col(f"h.c{i}") for i in range(len(names))]), F.lower)
    commas = F.size(F.split(F.regexp_replace("value", '"[^"]*"', ""), ","))
    same = (found == F.array(*map(F.lit, names))) & (commas == len(names))
    wrong = heads.where((F.trim("value") != "") & ~F.coalesce(same, F.lit(False))).limit(1).collect()
    if wrong:
        raise ValueError(f"a header does not have the columns of the schema: {wrong[0].value!r}")
    rows = records.where(F.coalesce("record", F.lit(-1)) != 0).where(F.trim("value") != "")
    return _parsed(rows, parse, schema, mode)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.options(**_CSV_WRITE).mode(mode).csv(path)


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType, mode: str = "FAILFAST"
) -> DataFrame:
    """One JSON object on each line; a malformed one fails the job unless `mode` says otherwise."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def read_json_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    partitions: int | None = None,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Files that hold one JSON array of objects, or one object, on any number of lines. A file that
    is broken anywhere fails the job unless `mode` says otherwise.

    A large file is read by many tasks, and twice: elements are cut where they end, whether or not
    a line ends there. `partitions` spreads the rows for what follows.
    """
    records = ranges.read_records(spark, path, ranges.Nested())
    # Before an object stands the array's begin or a comma; behind the last one the array's end.
    text = F.regexp_replace("value", r"^\s*[\[,]?\s*(?=\{)", "")
    rows = records.where(~F.col("value").rlike(r"^[\s\]]*$")).select(text.alias("value"))
    rows = rows.where(~F.col("value").rlike(r"^\s*\[\s*\]\s*$"))  # an array without elements

    def parse(wanted: T.StructType, options: dict) -> Column:
        return F.from_json("value", wanted, options)

    df = _parsed(rows, parse, schema, mode)
    return df.repartition(partitions) if partitions else df


def read_json_flat(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """JSON documents with nested records as dotted columns."""
    return records.flatten(read_json_documents(spark, path, schema))


def read_json_list_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType
) -> DataFrame:
    """A JSON list on each line, one row for each element; broken lines are skipped."""
    return records.payload_list(spark.read.text(path), schema)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.option("ignoreNullFields", "false").mode(mode).json(path)


def write_json_documents(df: DataFrame, path: str, key: Sequence[str], files: int) -> None:
    """Files of one JSON array each, below `path`/part=N, rows spread by the hash of `key`.

    Readers parse an array file in one task, so `files` should grow with the data. `key` should
    identify a row: hashing it keeps the files even whatever value is frequent.
    """
    part = F.pmod(F.xxhash64(*key), F.lit(files)).cast("int")
    rows = df.select(part.alias("part"), records.to_payload().alias("line"))
    in_part = Window.partitionBy("part").orderBy("line")
    rows = rows.select(
        "part",
        "line",
        F.row_number().over(in_part).alias("at"),
        F.lead("part").over(in_part).isNull().alias("last"),
    )
    opening = F.when(F.col("at") == 1, "[").otherwise("")
    closing = F.when(F.col("last"), "]").otherwise(",")
    (
        rows.select("part", "at", F.concat(opening, "line", closing).alias("value"))
        .sortWithinPartitions("part", "at")
        .select("part", "value")
        .write.partitionBy("part")
        .text(path)
    )


def preview(df: DataFrame, n: int = 5, order: Sequence[str | Column] = ()) -> DataFrame:
    """First rows for the caller to look at; with `order`, the same rows every time."""
    return (df.orderBy(*order) if order else df).limit(n)
