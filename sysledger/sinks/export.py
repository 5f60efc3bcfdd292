"""Listing export to delimited text (the scripts' ``\\o file``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMPTY_MARK = "\x01"

EXPORT_SCHEMA_OPTIONS = {
    "header": "true",
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def export_text(df: DataFrame, path: str, sep: str = "|", *, header: bool = True, mode: str = "overwrite") -> None:
    """Write a listing as delimited text, one part file per task (a large
    listing is never funnelled through one task). Nulls are empty fields, empty
    texts are quoted ones."""
    opts = dict(EXPORT_SCHEMA_OPTIONS, sep=sep, header=str(header).lower())
    df.write.mode(mode).options(**opts).csv(path)


def read_export(spark: SparkSession, path: str, schema, sep: str = "|") -> DataFrame:
    """Read an exported listing back with its schema."""
    # the reader takes a quoted empty field for null too, unless it has a name
    opts = dict(EXPORT_SCHEMA_OPTIONS, sep=sep, emptyValue=EMPTY_MARK)
    df = spark.read.options(**opts).schema(schema).csv(path)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.when(F.col(f"`{c}`") == EMPTY_MARK, "").otherwise(F.col(f"`{c}`")).alias(c) if c in text else F.col(f"`{c}`")
                       for c in df.columns])

