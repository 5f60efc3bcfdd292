"""Join-strategy helpers.

A side is broadcast only when a bounded count proves it fits; beyond
the bound the planner keeps its shuffled join (sort-merge, which spills),
and AQE may still re-plan it from runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcast budget per side. Every executor holds the whole side.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}
# Assumed width of a variable-length value where only rows are known;
# ``fits_broadcast`` measures the strings themselves.
_VAR_WIDTH = 48


def row_width(schema: T.StructType) -> int:
    """Upper-side estimate of the bytes one row takes in a broadcast
    relation (values plus an 8-byte slot each)."""
    total = 16
    for f in schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            w = 16
        elif isinstance(f.dataType, T.StructType):
            w = row_width(f.dataType)
        else:
            w = _WIDTH.get(type(f.dataType), _VAR_WIDTH)
        total += w + 8
    return total


def max_broadcast_rows(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> int:
    return max(1, max_bytes // row_width(df.schema))


def _size(df: DataFrame) -> DataFrame:
    """One row: rows and bytes of all strings, by partial aggregation."""
    text = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)).cast("long") for f in df.schema.fields
            if isinstance(f.dataType, T.StringType)]
    total = F.coalesce(F.sum(sum(text, F.lit(0).cast("long"))), F.lit(0))
    return df.agg(F.count(F.lit(1)).alias("n"), total.alias("text"))


def _fits(df: DataFrame, n: int, text: int, max_bytes: int) -> bool:
    """Rows at their fixed width plus the measured bytes of the strings."""
    strings = sum(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    return n * (row_width(df.schema) - strings * _VAR_WIDTH) + text <= max_bytes


def fits_broadcast(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` fits the budget by its row count and the bytes of its
    strings.

    An exact sum with partial aggregation: every task adds up its own rows
    and only two numbers per task move."""
    r = _size(df).first()
    return _fits(df, r.n, r.text, max_bytes)


def fits_broadcast_all(*dfs: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> list[bool]:
    """``fits_broadcast`` for several independent sides in one Spark job
    (one row per side, unioned)."""
    sizes = None
    for i, df in enumerate(dfs):
        one = _size(df).select(F.lit(i).alias("i"), "n", "text")
        sizes = one if sizes is None else sizes.unionByName(one)
    got = {r.i: r for r in sizes.collect()}
    return [_fits(df, got[i].n, got[i].text, max_bytes) for i, df in enumerate(dfs)]


def broadcast_if_small(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` behind a size check; otherwise ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df
