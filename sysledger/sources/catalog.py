"""Catalog, staging and history scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import align_schema


def read_catalog(spark: SparkSession, name: str, path_or_table: str | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """A catalog table (schemas, tables, views, functions, users, ...):
    a registered table by name, or a parquet path. With ``schema`` the
    columns are bound by name and cast to it."""
    target = path_or_table or name
    df = spark.read.parquet(target) if "/" in target or target.endswith(".parquet") else spark.table(target)
    return align_schema(df, schema) if schema is not None else df


def read_history(spark: SparkSession, store, name: str) -> DataFrame:
    """A staging or history table of ``store`` (``sysledger.sinks.tables.Tables``)."""
    return store.read(spark, name)


def read_mixed(spark: SparkSession, path: str, schema: T.StructType, *, keep_extra: bool = False) -> DataFrame:
    """One table from files that were written before and after columns were
    added: columns by name, null where a file does not have them, narrower
    number types of old files widened.

    The declared schema goes to the scan, so no footer is read to find it out
    and files are pruned as usual. With ``keep_extra`` the schemas of all files
    are merged instead (one distributed pass over the footers) and columns that
    the schema does not declare are kept at the end; the files must then agree
    on the types of columns they share."""
    if keep_extra:
        return align_schema(spark.read.option("mergeSchema", "true").parquet(path), schema, strict=False)
    return spark.read.schema(schema).parquet(path)
