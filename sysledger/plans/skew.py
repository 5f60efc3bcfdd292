"""Joins whose keys may be hot: a key that holds a large share of the rows is
cut into pieces before the rows are dealt by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hints import fits_broadcast

# A key is split if it holds more than one in this many rows, so at most this
# many keys are (the bound of the broadcast of their list).
SHARE = 1000


def join_split(left: DataFrame, right: DataFrame, keys: list[str], spread_by: str, *, how: str = "left", condition: Column | None = None,
               share: int = SHARE, max_broadcast_bytes: int | None = None) -> DataFrame:
    """``left`` joined with ``right`` on ``keys`` (and ``condition``).

    A right side within the broadcast budget, as measured, is broadcast. Else
    the keys that hold more than a ``share``-th of the left rows are counted
    (partial aggregation); a left row of such a key gets one of as many pieces
    as the key has shares, by its ``spread_by`` value, and the right rows of
    the key are repeated once a piece. No task gets much more than a
    ``share``-th of the left rows for one key. Rows with a null key match
    nothing and are not dealt by key."""
    options = {} if max_broadcast_bytes is None else {"max_bytes": max_broadcast_bytes}
    other = right.select(*[F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k) == F.col(f"__{k}") for k in keys]
    columns = [*left.columns, *[c for c in right.columns if c not in keys]]
    extra = [] if condition is None else [condition]
    if fits_broadcast(other, **options):
        return left.join(F.broadcast(other), on + extra, how).select(*columns)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    counts = left.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    hot = counts.where(F.col("__n") * share > total).select(
        *[F.col(k).alias(f"__hot_{k}") for k in keys], F.ceil(F.col("__n") * share / max(total, 1)).cast("int").alias("__pieces"))
    hot = F.broadcast(hot)  # fewer than ``share`` rows
    dealt = left.where(known).join(hot, [F.col(k) == F.col(f"__hot_{k}") for k in keys], "left").withColumn(
        "__piece", F.when(F.col("__pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread_by), F.col("__pieces"))).cast("int"))
    repeated = other.join(hot, [F.col(f"__{k}") == F.col(f"__hot_{k}") for k in keys], "left").withColumn(
        "__other_piece", F.explode(F.sequence(F.lit(0), F.coalesce("__pieces", F.lit(1)) - 1)))
    dealt, repeated = dealt.select(*left.columns, "__piece"), repeated.select(*other.columns, "__other_piece")
    met = dealt.join(repeated, on + [F.col("__piece") == F.col("__other_piece")] + extra, how).select(*columns)
    if how != "left":
        return met
    nameless = left.where(~known).select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in columns[len(left.columns):]])
    return met.unionByName(nameless)
