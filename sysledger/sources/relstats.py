"""Relation statistics: per-object uncompressed sizes.

``read_relation_stats`` reads a statistics table exported by the source
database. ``relation_stats`` estimates the same row for a relation from
its own rows, in one distributed aggregate (partial per partition, one
row per partition into the final task), for sources that export no
statistics.

Size rule (ours; the database's estimator is not public): each non-null
fixed-width value counts its width, a string its UTF-8 bytes, a binary its
bytes, an array ``elements x element width``; nulls count 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RELATION_STATS, align_schema

_FIXED = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def read_relation_stats(spark: SparkSession, path: str) -> DataFrame:
    return align_schema(spark.read.parquet(path), RELATION_STATS)


def _value_bytes(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.octet_length(c).cast("bigint")
    if isinstance(dtype, T.DecimalType):
        return F.when(c.isNotNull(), F.lit(16 if dtype.precision > 18 else 8)).cast("bigint")
    if isinstance(dtype, T.ArrayType):
        width = _FIXED.get(type(dtype.elementType))
        if width is None:
            raise TypeError(f"no size rule for arrays of {dtype.elementType.simpleString()}")
        return (F.size(c) * F.lit(width)).cast("bigint")
    width = _FIXED.get(type(dtype))
    if width is None:
        raise TypeError(f"no size rule for {dtype.simpleString()}")
    return F.when(c.isNotNull(), F.lit(width)).cast("bigint")


def relation_size(df: DataFrame) -> Column:
    """Aggregate expression: estimated uncompressed bytes of ``df``."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            # size() is -1 for a null array; a null counts 0
            parts.append(F.sum(F.when(c.isNotNull(), _value_bytes(c, f.dataType))))
        else:
            parts.append(F.sum(_value_bytes(c, f.dataType)))
    total = F.lit(0).cast("bigint")
    for p in parts:
        total = total + F.coalesce(p, F.lit(0).cast("bigint"))
    return total


def relation_stats(df: DataFrame, *, owner: str, database: str, schema: str, relation: str,
                   compression_level: str = "none", object_type: str = "relation") -> DataFrame:
    """One statistics row for ``df`` in the layout of the database's
    relation statistics."""
    return df.agg(relation_size(df).alias("uncompressed_size")).select(
        F.lit(owner).alias("owner_name"),
        F.lit(object_type).alias("object_type"),
        F.lit(database).alias("database"),
        F.lit(schema).alias("schema"),
        F.lit(relation).alias("relation"),
        F.lit(compression_level).alias("compression_level"),
        F.col("uncompressed_size"),
    )
