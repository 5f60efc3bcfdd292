"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# White space of the corpus contracts: space, tab, newline, vertical tab,
# form feed, carriage return. The same set is Java's and RE2's \s.
SPACES = r"[\x20\x09-\x0D]+"


ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table. Python workers are told where this package lies, so a
    session that was started elsewhere finds it too."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if ROOT not in known:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [*known, ROOT]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BATCH_ROWS = 512
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers in batches of at most BATCH_ROWS rows.
    Spark bounds a batch by rows alone, and its 10,000 rows are gigabytes where
    texts are long. The setting holds for the session, as plans run later; one
    that is lower stays."""
    now = int(spark.conf.get(BATCH_SETTING, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))


def release_memory() -> None:
    """Give freed memory back. Python workers live as long as their executor,
    and Arrow and the C library keep what tasks have freed for the next ones:
    memory that the executor counts in every later stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def released(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], forget: Callable[[], None] | None = None):
    """``work`` (for mapInArrow) that leaves no memory behind it; ``forget``
    empties what it keeps from one task to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            if forget:
                forget()
            release_memory()

    return run


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder, one per call."""
    small_batches(spark)
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start
    from files, so a lost executor costs only its running tasks."""
    path = f"{folder or scratch(df.sparkSession, name)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def unit_draw(*columns: Column) -> Column:
    """A number in (0, 1) that the columns' values decide."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


HOT_SHARE = 1000
BROADCAST_BYTES = 32 << 20


def broadcast_bytes(df: DataFrame) -> int:
    """Bytes that a written table takes in a broadcast: 16 a value (a slot and
    its share of the row) and the bytes of its strings, as measured."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    return df.agg(F.coalesce(F.sum(sum(text, F.lit(16 * len(df.columns) + 16).cast("long"))), F.lit(0))).first()[0]


def join_totals(rows: DataFrame, totals: DataFrame, keys: list[str], n: int, folder: str, name: str = "totals",
                how: str = "left", limit: int = BROADCAST_BYTES) -> DataFrame:
    """``rows`` joined (``how``: left or inner) with one row of ``totals`` a
    key (nulls match), where ``totals.n`` is the number of rows that hold the
    key and ``n`` the number of all of them. Totals of ``limit`` measured bytes
    at most are broadcast. Of larger ones, the keys of a thousandth of the rows
    or more are broadcast, a thousand at most; the others are shuffled, so no
    task gets more than a thousandth of the rows for one key."""
    totals = materialise(totals, name, folder)
    others = [c for c in totals.columns if c not in (*keys, "n")]

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"__{tag}_{c}") for c in (*keys, *others)], F.lit(True).alias(f"__{tag}"))

    def same(tag: str) -> list[Column]:
        return [F.col(k).eqNullSafe(F.col(f"__{tag}_{k}")) for k in keys]

    def result(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*rows.columns, *[F.col(f"__{tag}_{c}").alias(c) for c in others])

    if broadcast_bytes(totals) <= limit:
        return result(rows.join(F.broadcast(side(totals, "all")), same("all"), how), "all")
    often = F.col("n") * HOT_SHARE >= n
    marked = rows.join(F.broadcast(side(totals.where(often), "hot")), same("hot"), "left")
    rare = marked.where("__hot is null").select(*rows.columns).join(side(totals.where(~often), "cold"), same("cold"), how)
    return result(marked.where("__hot"), "hot").unionByName(result(rare, "cold"))
