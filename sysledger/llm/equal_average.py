"""Product codes of vectors by equal-average nearest-entry search.

Vectors are cut into equal consecutive parts; each part position has a
codebook. To find the nearest entry of a part, the entries are sorted by the
sum of their components. Two parts of d components whose sums differ by g are
at least g^2 / d apart (squared distance), so the search starts between the
entries whose sums enclose the part's sum and goes outward, always to the
nearer sum; a part is done once g^2 / d strictly exceeds its best distance.
Entries at that same distance are still looked at, so ties go to the lower
index as in a full search.

Everything is done in whole numbers: a component x is floor(``scale`` * x).
A codebook starts as that part of the first ``entries`` kept rows by vec_id.
Each of ``rounds`` rounds assigns every part and replaces each used entry by
floor(sum / count) of its parts; at the end the parts are assigned once more.

How the work is spread: the whole numbers are written once to the shared
folder. A round is one scan of them: every task adds up its own rows by
(part, entry) and sends one row for each, so the shuffle is tasks x parts x
entries rows; the driver gets the codebooks alone (parts x entries x d
numbers, whatever the input). The error by label is summed with partial
aggregation and joined back, the labels that hold a thousandth of all rows or
more by a broadcast of at most a thousand rows.

Defined cases. Rows go whose vector is null, holds a null or a component that
is not finite, or has another length than the first kept row (by vec_id) whose
length is a positive multiple of ``parts``. Components of
``LIMIT`` / d or more after scaling end the job with an error: squared
distances would not fit a long (at d = 8 and scale 4096: components of 32768). Rows
without vec_id are coded too and come last in the order; rows that repeat a
vec_id come in the order of their vectors, each is coded and each counts.
Fewer kept rows than ``entries`` give shorter codebooks, equal entries stay
apart (the lower index wins). An empty table gives an empty result. Other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_totals, materialise, scratch

LIMIT = 1 << 30  # most that a part's length times a component may be
BLOCK = 8192  # most rows searched at a time


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For each row the index of its nearest entry and the squared distance,
    and how many distances were computed. ``rows`` (n, d), ``entries`` (k, d)."""
    n, d = rows.shape
    order = np.argsort(entries.sum(axis=1), kind="stable")
    sums, sorted_entries = entries.sum(axis=1)[order], entries[order]
    own = rows.sum(axis=1)
    right = np.searchsorted(sums, own)
    left = right - 1
    best = np.full(n, np.iinfo(np.int64).max)
    found = np.full(n, len(entries))
    far = np.iinfo(np.int64).max
    active, computed = np.arange(n), 0
    while len(active):
        lo, hi = left[active], right[active]
        gap_lo = np.where(lo >= 0, own[active] - sums[np.maximum(lo, 0)], far)
        gap_hi = np.where(hi < len(sums), sums[np.minimum(hi, len(sums) - 1)] - own[active], far)
        down = gap_lo <= gap_hi
        gap = np.where(down, gap_lo, gap_hi)
        seen = best[active] < far
        open_ = (gap < far) & (~seen | (gap**2 <= best[active] * d))
        active, down, lo, hi = active[open_], down[open_], lo[open_], hi[open_]
        if not len(active):
            break
        at = np.where(down, lo, hi)
        away = ((rows[active] - sorted_entries[at]) ** 2).sum(axis=1)
        computed += len(active)
        index = order[at]
        better = (away < best[active]) | ((away == best[active]) & (index < found[active]))
        best[active[better]], found[active[better]] = away[better], index[better]
        left[active[down]] -= 1
        right[active[~down]] += 1
    return found, best, computed


def _scaled(scale: int, parts: int):
    """The rows without nulls and other unusable components, in whole numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            flat = vectors.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes nan
            lengths = vectors.value_lengths().fill_null(0).to_numpy()
            owner = np.repeat(np.arange(len(vectors)), lengths)
            good = vectors.is_valid().to_numpy(zero_copy_only=False)
            good[owner[~np.isfinite(values)]] = False
            whole = np.floor(np.where(np.isfinite(values), values, 0) * scale)
            most = LIMIT // np.maximum(lengths // parts, 1)
            if (good[owner] & (np.abs(whole) >= most[owner])).any():
                raise OverflowError("a component is too large: squared distances would not fit a long")
            ends = np.append(0, np.cumsum(np.where(good, lengths, 0)))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(whole[good[owner]].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["vec_id", "label", "v"]).filter(pa.array(good))

    return work


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches joined or cut to at most BLOCK rows."""
    held, n = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            held.append(batch.slice(start, BLOCK))
            n += held[-1].num_rows
            if n >= BLOCK:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=BLOCK)
                held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches(max_chunksize=BLOCK)


def _matrix(batch: pa.RecordBatch, column: int, parts: int) -> np.ndarray:
    """(rows, parts, d) of a list column whose lists are all of one length."""
    lists = batch.column(column)
    return lists.flatten().to_numpy().astype(np.int64).reshape(len(lists), parts, -1)


def _sums(codebooks: np.ndarray):
    """One task's sums by (part, entry): the count, then the components."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, d = codebooks.shape
        total = np.zeros((parts, entries, d + 1), dtype=np.int64)
        for block in _blocks(batches):
            rows = _matrix(block, 0, parts)
            for p in range(parts):
                code, _, _ = nearest(rows[:, p], codebooks[p])
                total[p, :, 0] += np.bincount(code, minlength=entries)
                np.add.at(total[p, :, 1:], code, rows[:, p])
        p, e, i = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(i, pa.int32()),
                                          pa.array(total[p, e, i], pa.int64())], ["part", "entry", "place", "total"])

    return work


def _codes(codebooks: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(codebooks)
        for block in _blocks(batches):
            rows = _matrix(block, 2, parts)
            found = [nearest(rows[:, p], codebooks[p]) for p in range(parts)]
            codes = np.stack([f[0] for f in found], axis=1)
            error = np.sum([f[1] for f in found], axis=0)
            text = ["".join(f"{c:02x}" for c in row) for row in codes.tolist()]
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), pa.array(text, pa.string()), pa.array(error, pa.int64())],
                                             ["vec_id", "label", "code", "error"])

    return work


def whole_vectors(rows: DataFrame, parts: int, scale: int, folder: str, id_col: str = "vec_id", vector_col: str = "embedding",
                  label_col: str = "label") -> DataFrame:
    """The kept rows as (vec_id, label, v), written to the shared folder."""
    narrow = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                         F.col(vector_col).cast("array<double>").alias("v"))
    label = narrow.schema["label"].dataType.simpleString()
    kept = materialise(narrow.mapInArrow(_scaled(scale, parts), f"vec_id long, label {label}, v array<int>"), "whole", folder)
    first = first_rows(kept.where((F.size("v") > 0) & (F.size("v") % parts == 0)), 1)
    return kept.where(F.size("v") == (len(first[0]) if first else 0))


def first_rows(vectors: DataFrame, n: int) -> list[list[int]]:
    """The vectors of the first n rows by vec_id (none last, ties by vector)."""
    return [r.v for r in vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(n).select("v").collect()]


def train(vectors: DataFrame, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (parts, entries, d) after ``rounds`` rounds over all rows."""
    start = first_rows(vectors, entries)
    if not start:
        return np.zeros((parts, 0, 0), dtype=np.int64)
    codebooks = np.array(start, dtype=np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = vectors.select("v").mapInArrow(_sums(codebooks), "part int, entry int, place int, total long")
        total = np.zeros((parts, codebooks.shape[1], codebooks.shape[2] + 1), dtype=np.int64)
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
            total[r.part, r.entry, r.place] = r.total
        used = total[:, :, 0] > 0
        codebooks[used] = total[used][:, 1:] // total[used][:, :1]
    return codebooks


def digest(codebooks: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def product_codes(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096, **columns: str) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 for each kept
    row of ``rows`` (columns vec_id, embedding, label, or as named)."""
    folder = scratch(rows.sparkSession, "equal-average")
    vectors = whole_vectors(rows, parts, scale, folder, **columns)
    codebooks = train(vectors, parts, entries, rounds)
    label = vectors.schema["label"].dataType.simpleString()
    coded = materialise(vectors.mapInArrow(_codes(codebooks), f"vec_id long, label {label}, code string, error long"), "coded", folder)
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n"))
    return join_totals(coded, totals, ["label"], coded.count(), folder).withColumn("codebooks_sha256", F.lit(digest(codebooks)))
