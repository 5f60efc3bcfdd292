"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every row gets the SHA-256 of its normalised text. These narrow rows are
   written once to the shared folder and dealt to senders of bounded size.
2. A sender keeps the first ``L`` bits of each digest (``L`` = bits of the row
   count + ``slack_bits``), sorts the distinct values, cuts them by owner (a
   range of values) and sends each owner the gaps as Golomb-Rice codes: about
   ``slack_bits`` + 1.5 bits a row instead of 256.
3. An owner merges the lists it got and answers each sender with a bitmap: bit
   i says that another sender also holds the i-th value.
4. A sender's suspects are the rows whose value it holds twice or whose bit
   is set. Their values fill a filter of fixed size (``filter_bits``), which
   goes back over the documents, so that only suspects' texts are shuffled.
5. Suspects are grouped by the normalised text itself: byte equality decides.
   Copies are summed in the scan's own task first, so a text that holds a
   third of all rows is one row for each task.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` is
replaced by one space; a null text counts as empty. The row with the smallest
doc_id stays (null ids only if the class has no other); of rows that repeat an
id, one stays. An empty table gives an empty result. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, SPACES, broadcast_bytes, join_totals, materialise, scratch

ROWS_PER_SENDER = 250_000
ROWS_PER_OWNER = 250_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


# --- Golomb-Rice codes ------------------------------------------------------


def rice_encode(values: np.ndarray, k: int) -> bytes:
    """Sorted distinct uint64 values as gaps: quotient in unary (that many
    ones, then a zero), then the low ``k`` bits of the gap."""
    gaps = np.diff(values, prepend=np.uint64(0))
    quotient = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotient + 1 + k)
    starts = ends - (quotient + 1 + k)
    # the ones: +1 at the start of each unary run, -1 after it, summed up
    steps = np.zeros(int(ends[-1]) + 1, dtype=np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + quotient, -1)
    bits = np.cumsum(steps[:-1]).astype(np.uint8)
    low = starts + quotient + 1
    for j in range(k):
        bits[low + j] = (gaps >> np.uint64(k - 1 - j)) & np.uint64(1)
    return np.packbits(bits).tobytes()


def rice_decode(payload: bytes, n: int, k: int) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(payload, dtype=np.uint8))
    zeros = np.flatnonzero(bits == 0)
    # the zero that ends each unary run: the first zero at or after its start
    quotient = np.empty(n, dtype=np.uint64)
    low = np.empty(n, dtype=np.int64)
    at = 0
    following = np.searchsorted(zeros, np.arange(0, len(bits) + 1))
    for i in range(n):
        end = int(zeros[following[at]])
        quotient[i] = end - at
        low[i] = end + 1
        at = end + 1 + k
    rest = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        rest = (rest << np.uint64(1)) | bits[low + j].astype(np.uint64)
    return np.cumsum((quotient << np.uint64(k)) | rest, dtype=np.uint64)


def rice_parameter(universe: int, n: int) -> int:
    """Bits of the mean gap of n values below ``universe``, less the fraction."""
    return max(0, int(universe // max(n, 1)).bit_length() - 1)


def _values(digests: pd.Series, bits: int) -> np.ndarray:
    if not len(digests):
        return np.zeros(0, dtype=np.uint64)
    first = np.frombuffer(b"".join(d[:8] for d in digests), dtype=">u8").astype(np.uint64)
    return first >> np.uint64(64 - bits)


def _owner_bounds(owners: int, bits: int) -> list[int]:
    return [(o << bits) // owners for o in range(owners + 1)]


def _sender(bits: int, owners: int):
    bounds = np.array(_owner_bounds(owners, bits)[1:-1], dtype=np.uint64)

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        mine = np.unique(_values(rows["digest"], bits))
        out = []
        for owner, part in enumerate(np.split(mine, np.searchsorted(mine, bounds))):
            if len(part):
                k = rice_parameter((1 << bits) // owners, len(part))
                base = np.uint64((owner << bits) // owners)
                out.append((owner, int(rows["sender"].iloc[0]), len(part), k, rice_encode(part - base, k)))
        return pd.DataFrame(out, columns=["owner", "sender", "n", "k", "payload"])

    return encode


def _owner(messages: pd.DataFrame) -> pd.DataFrame:
    parts = [rice_decode(m.payload, m.n, m.k) for m in messages.itertuples()]
    merged = np.sort(np.concatenate(parts))
    twice = np.unique(merged[1:][merged[1:] == merged[:-1]])
    marks = [np.packbits(np.isin(part, twice)).tobytes() for part in parts]
    return pd.DataFrame({"sender": messages["sender"], "owner": messages["owner"], "marks": marks})


def _suspects(bits: int, owners: int):
    bounds = np.array(_owner_bounds(owners, bits)[1:-1], dtype=np.uint64)

    def find(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"row_id": [], "doc_id": [], "digest": []})
        values = _values(rows["digest"], bits)
        mine, counts = np.unique(values, return_counts=True)
        marked = counts > 1
        marks = dict(zip(answers["owner"], answers["marks"], strict=True))
        cut = [0, *np.searchsorted(mine, bounds), len(mine)]
        for owner in range(owners):
            a, b = cut[owner], cut[owner + 1]
            if b > a:
                got = np.unpackbits(np.frombuffer(marks[owner], dtype=np.uint8))[: b - a]
                marked[a:b] |= got.astype(bool)
        found = rows[marked[np.searchsorted(mine, values)]]
        return found[["row_id", "doc_id", "digest"]]

    return find


# --- the filter that goes back over the documents ---------------------------

SEGMENT_BITS = 1 << 16


def _filter_positions(digests: list[bytes], filter_bits: int) -> np.ndarray:
    """Two positions for each digest, from bytes 8 to 24 of it."""
    words = np.frombuffer(b"".join(d[8:24] for d in digests), dtype=">u8").astype(np.uint64)
    return (words % np.uint64(filter_bits)).astype(np.int64).reshape(-1, 2)


def _segments(filter_bits: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.unique(_filter_positions(batch.column("digest").to_pylist(), filter_bits)) if batch.num_rows else []
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at // SEGMENT_BITS, pa.int32()), pa.array(at % SEGMENT_BITS, pa.int32())], ["segment", "bit"])

    return fill


def _segment(rows: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(SEGMENT_BITS, dtype=np.uint8)
    bits[rows["bit"].to_numpy()] = 1
    return pd.DataFrame({"segment": [int(rows["segment"].iloc[0])], "bits": [np.packbits(bits).tobytes()]})


def suspect_filter(digests: DataFrame, filter_bits: int) -> bytes:
    """A bitmap of fixed size (``filter_bits`` / 8 bytes, whatever the input)
    of the digests; the only thing that comes to the driver."""
    rows = (digests.mapInArrow(_segments(filter_bits), "segment int, bit int").distinct()
            .groupBy("segment").applyInPandas(_segment, "segment int, bits binary"))
    empty = bytes(SEGMENT_BITS // 8)
    have = {r.segment: bytes(r.bits) for r in rows.collect()}
    return b"".join(have.get(s, empty) for s in range(filter_bits // SEGMENT_BITS))


def _pass_filter(bitmap, filter_bits: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            if batch.num_rows:
                at = _filter_positions(batch.column("digest").to_pylist(), filter_bits)
                hit = (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
                yield batch.filter(pa.array(hit.all(axis=1)))

    return keep


# --- the operator -----------------------------------------------------------


def exact_dedup(docs: DataFrame, slack_bits: int = 16, filter_bits: int = 1 << 27) -> DataFrame:
    """One row for each row of ``docs`` (columns doc_id, text): doc_id,
    keep_id, group_size, kept, text_sha256, as the module says."""
    spark = docs.sparkSession
    folder = scratch(spark, "exact-dedup")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    texts = texts.withColumn("digest", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)))
    rows = materialise(texts.select("doc_id", "digest", F.monotonically_increasing_id().alias("row_id")), "digests", folder)

    n = rows.count()  # from the files' footers
    bits = min(62, max(n, 2).bit_length() + slack_bits)
    senders, owners = -(-n // ROWS_PER_SENDER) or 1, -(-n // ROWS_PER_OWNER) or 1
    # a few of each at least, so that small tables use the machines too
    senders, owners = max(8, senders), max(8, owners)
    sent = rows.withColumn("sender", F.pmod(F.xxhash64("row_id"), F.lit(senders)).cast("int"))
    messages = sent.groupBy("sender").applyInPandas(
        _sender(bits, owners), "owner int, sender int, n int, k int, payload binary")
    answers = messages.groupBy("owner").applyInPandas(_owner, "sender int, owner int, marks binary")
    suspects = materialise(
        sent.groupBy("sender").cogroup(answers.groupBy("sender")).applyInPandas(
            _suspects(bits, owners), "row_id long, doc_id long, digest binary"), "suspects", folder)

    bitmap = spark.sparkContext.broadcast(suspect_filter(suspects.select("digest"), filter_bits))
    # byte verification: the normalised text is the grouping key
    classes = (texts.mapInArrow(_pass_filter(bitmap, filter_bits), "doc_id long, norm string, digest binary")
               .groupBy("digest", "norm").agg(F.count("*").alias("group_size")).where("group_size > 1")
               .select("digest", "group_size"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_id"))
    heads = suspects.groupBy("digest").agg(first.alias("head"))
    found = classes.join(heads, "digest").select(
        "digest", F.col("group_size").alias("n"), "group_size", F.col("head.doc_id").alias("keep_id"), F.col("head.row_id").alias("keep_row"))
    single = F.col("group_size").isNull()
    return join_totals(rows, found, ["digest"], n, folder, "classes").select(
        "doc_id",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (single | (F.col("row_id") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class of equal texts, all its columns.

    What goes is named by narrow rows, (doc_id, digest), which are broadcast if
    their measured size allows it: then no text is shuffled. Rows that repeat
    both the id and the text of a row that stays are told apart in a second
    step, on these rows alone."""
    folder = scratch(docs.sparkSession, "drop-copies")
    named = [F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__digest")]
    copies = materialise(exact_dedup(docs, **options).where("group_size > 1"), "copies", folder)
    gone = materialise(copies.where(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(*named).distinct(), "gone", folder)
    heads = copies.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy(*named).count()
    repeated = materialise(heads.where(F.col("count") > 1).select("__id", "__digest"), "repeated", folder)
    digest = F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256))
    keyed = docs.withColumn("__own", digest)

    def same(df: DataFrame) -> tuple[DataFrame, Column]:
        side = F.broadcast(df) if broadcast_bytes(df) <= BROADCAST_BYTES else df
        return side, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest"))

    kept = keyed.join(*same(gone), "left_anti")
    once = kept.join(*same(repeated), "left_anti")
    again = kept.join(*same(repeated), "left_semi").dropDuplicates(["__own"])
    return once.unionByName(again).select(*docs.columns)
