"""Audit of how text filters interact, by a Gray-code walk over their subsets.

Every document gets a mask, bit i for "fails filter i". Documents are counted
by (part, mask) with how many are good and toxic: at most 32 cells a part, by
partial aggregation. All that the orders of the filters ask is then decided by
these cells:

- A walk visits all 32 subsets of the filters in Gray-code order, so each step
  switches one filter on or off. Every cell keeps the number of active filters
  that it fails; a step adds or takes one in the cells that fail the switched
  filter, and the cells whose number becomes or stops being zero leave or join
  the running survivors. The survivors of each of the 32 states are stored.
- A step of an order goes from the state of the filters before it to that
  state with its own filter; the difference of the two is what it removes.

Filters (words are maximal runs ``[^\\x20\\x09-\\x0D]+``, case-sensitive; a null
text is empty): A under 100 words; B 100 * distinct words < 80 * words; C 100 *
characters of ``[A-Z]`` > 10 * code points; D holds any of ``#$%&*|``; E
identical to the text of a smaller doc_id anywhere in the table.

How the work is spread: one pass over the texts gives narrow rows (ids, part,
four bits, SHA-256 of the text), written once. Equal texts are found by
grouping on the digest; only digests of several rows are joined back, those of
a thousandth of all rows or more by a broadcast of at most a thousand rows. The
walk gets one row a part.

Defined cases: a null lang is the part of the empty string. An empty text fails
A only (no words, so no share of them). A row without doc_id neither fails E nor
makes another fail it; rows that share the smallest doc_id of a text all pass
E. Several label rows of a document count once: good if one says quality 1,
toxic if one says toxic 1. An empty table gives an empty result. Other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_totals, materialise, scratch

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 100, 80, 10


def text_mask(text: bytes, code_points: int) -> int:
    """The bits of the filters that the text alone decides."""
    words = text.split()  # bytes split at exactly \x20 and \x09-\x0D
    n = len(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    fails = (
        n < MIN_WORDS,
        100 * len(set(words)) < MIN_DISTINCT_PERCENT * n,
        100 * capitals > MAX_CAPITAL_PERCENT * code_points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column(2).to_pylist()]
        raw = [t.encode() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([text_mask(b, len(t)) for b, t in zip(raw, texts, strict=True)], pa.int32()),
             pa.array([hashlib.sha256(b).digest() for b in raw], pa.binary())], ["doc_id", "part", "mask", "digest"])


# --- the walk ----------------------------------------------------------------


def subset_states(masks: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """(2^n, columns of ``counts``): what survives under each subset of n
    filters, by a Gray-code walk over the cells (mask, counts)."""
    states = np.zeros((1 << n, counts.shape[1]), dtype=np.int64)
    failing = np.zeros(len(masks), dtype=np.int64)  # active filters that each cell fails
    running = counts.sum(axis=0)
    states[0] = running
    active = 0
    for step in range(1, 1 << n):
        flipped = (step & -step).bit_length() - 1
        active ^= 1 << flipped
        on = bool(active >> flipped & 1)
        hit = (masks >> flipped & 1).astype(bool)
        if on:
            running = running - counts[hit & (failing == 0)].sum(axis=0)
            failing[hit] += 1
        else:
            failing[hit] -= 1
            running = running + counts[hit & (failing == 0)].sum(axis=0)
        states[active] = running
    return states


def audit(masks: np.ndarray, counts: np.ndarray, filters: str = FILTERS) -> list[tuple]:
    """A row for each order and step, from the cells of one part. Columns of
    ``counts``: documents, good ones, toxic ones."""
    n = len(filters)
    states = subset_states(masks, counts, n)
    fails = [int(counts[masks >> i & 1 == 1, 0].sum()) for i in range(n)]
    only = [int(counts[masks == 1 << i, 0].sum()) for i in range(n)]
    rows, total = [], [0] * n
    for order in permutations(range(n)):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            lost = states[before] - states[before | 1 << i]
            before |= 1 << i
            total[i] += int(lost[0])
            rows.append((name, step, i, int(states[before][0]), *map(int, lost)))
    return [(name, step, kept, removed, fails[i] - removed, only[i], good, toxic, total[i])
            for name, step, i, kept, removed, good, toxic in rows]


RESULT = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def _walk(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in rows:
        for part, cells in zip(batch["part"], batch["cells"], strict=True):
            table = np.array([list(c) for c in cells], dtype=np.int64)
            out = pd.DataFrame(audit(table[:, 0], table[:, 1:]), columns=RESULT)
            out.insert(0, "part", part)
            yield out


# --- the operator ------------------------------------------------------------


def failure_masks(docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, part, mask (all five bits) for each row of ``docs``."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    rows = materialise(narrow.mapInArrow(_masks, "doc_id long, part string, mask int, digest binary"), "masks", folder)
    several = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    joined = join_totals(rows, several, ["digest"], rows.count(), folder, "copies")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return joined.select("doc_id", "part", F.when(copy, F.col("mask") + COPY).otherwise(F.col("mask")).alias("mask"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the five filters and step, as the module
    says. ``docs``: doc_id, text, lang; ``labels``: doc_id, quality, toxic."""
    folder = scratch(docs.sparkSession, "filter-audit")
    masks = failure_masks(docs, folder)
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # rows of one id (or without one) that are alike are one row to the join
    alike = masks.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    cells = alike.join(marks, "doc_id", "left").groupBy("part", "mask").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(a)
          for a, c in (("docs", F.col("n")), ("good", F.col("n") * F.col("good")), ("toxic", F.col("n") * F.col("toxic")))])
    parts = cells.groupBy("part").agg(F.collect_list(F.array(F.col("mask").cast("long"), "docs", "good", "toxic")).alias("cells"))
    schema = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in RESULT[2:])
    return parts.mapInPandas(_walk, schema)
