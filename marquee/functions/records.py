"""JSON payloads and nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_payload(*columns: str) -> Column:
    """The row as JSON text. Null fields are written, so every message has all its fields."""
    return F.to_json(F.struct(*(columns or ("*",))), {"ignoreNullFields": "false"})


def from_payload(text: Column, schema: T.StructType) -> Column:
    """JSON text to a struct; text that is no JSON gives a struct of nulls."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def payload_rows(
    df: DataFrame, schema: T.StructType, required: str, column: str = "value"
) -> DataFrame:
    """Replace the message column by its fields, dropping messages without `required`.

    A message that cannot be decoded has no fields, so it is dropped by the same test.
    """
    rest = [name for name in df.columns if name != column]
    # A test on a generated column stays above the generator, so each message is parsed once; a
    # test on a projected struct would be pushed below and parse it a second time.
    parsed = from_payload(F.col(column).cast("string"), schema)
    rows = df.select(*rest, F.inline_outer(F.array(parsed)))
    return rows.filter(F.col(f"`{required}`").isNotNull())


def payload_list(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """One row for each element of the JSON list held by each line; undecodable lines are skipped."""
    items = F.from_json(F.col(column), T.ArrayType(schema), {"mode": "PERMISSIVE"})
    rows = df.select(F.explode_outer(items).alias("_item"))
    return rows.filter("_item IS NOT NULL").select("_item.*")


def flat_columns(schema: T.StructType, prefix: tuple[str, ...] = ()) -> list[Column]:
    columns: list[Column] = []
    for field in schema.fields:
        path = (*prefix, field.name)
        if isinstance(field.dataType, T.StructType):
            columns += flat_columns(field.dataType, path)
        else:
            source = ".".join(f"`{part}`" for part in path)
            columns.append(F.col(source).alias(".".join(path)))
    return columns


def flatten(df: DataFrame) -> DataFrame:
    """Nested structs as top-level columns with dotted names; arrays stay as they are."""
    return df.select(*flat_columns(df.schema))
