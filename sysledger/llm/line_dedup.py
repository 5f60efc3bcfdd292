"""Removal of lines that many documents share, in column functions only.

1. Texts are split at newlines, lines exploded and normalised to keys: white
   space ``[\\x20\\x09-\\x0D]`` stripped at both ends, A-Z in lower case. Keys of
   ``min_chars`` code points or more count, as two 64-bit hashes.
2. The keys are counted with partial aggregation, so a line that a third of all
   documents hold is one row a task. Only keys with at least ``min_docs`` lines
   can be in as many documents: the others, nearly all, end here.
3. The lines of the remaining keys are found again by a join: (key, document,
   position), narrow rows, written once. From these come the exact numbers of
   distinct documents and each key's largest doc_id.
4. The lines of keys at the threshold are dropped, but in the largest doc_id;
   dropped positions are gathered by document, and each text is put together
   again from the positions that stay.

How the work is spread: both joins on keys take the keys of a thousandth of all
lines or more by a broadcast of at most a thousand rows and shuffle the rest
(``common.join_totals``; small tables of keys are broadcast as measured).
Positions are gathered per text, which is one row anyway. They are broadcast if
their measured bytes allow it; else texts and positions are joined by shuffling,
one text a row.

Defined cases: a null or empty text is one empty line. Rows that share a doc_id
are one document to the counts and to the rule for the largest; each keeps or
loses its own lines. Rows without doc_id count as no document and are never
the largest: a key that is dropped goes from them too. A key twice in one
document counts once, and the largest doc_id keeps both lines. Positions are
looked up in a mask, in time linear in the text. An empty table gives an empty
result. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, broadcast_bytes, join_totals, materialise, scratch

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYS = ["h1", "h2"]
DOC = ["doc_id", "text_hash"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line stripped, A-Z in lower case (no other letter changes)."""
    bare = F.btrim(line, F.lit(BLANKS))
    # lower() changes A-Z alone where every character is one byte
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _texts(docs: DataFrame) -> DataFrame:
    """doc_id, text, text_hash; the last two name a row: rows that are equal
    in both have the same result."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def _long_lines(texts: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, text_hash, at, h1, h2) for each line whose key is long enough."""
    exploded = texts.select("doc_id", "text_hash", F.posexplode(lines_of(F.col("text"))).alias("at", "line"))
    # bytes are at least code points, and cheap to count
    keyed = exploded.where(F.octet_length("line") >= min_chars).select("doc_id", "text_hash", "at", line_key(F.col("line")).alias("line_key"))
    return keyed.where(F.length("line_key") >= min_chars).select(
        "doc_id", "text_hash", "at", F.xxhash64("line_key").alias("h1"), F.xxhash64(F.lit(1), F.col("line_key")).alias("h2"))


def dropped_lines(texts: DataFrame, min_chars: int, min_docs: int, folder: str) -> DataFrame:
    """(doc_id, text_hash, at): the lines that go, once for each row name."""
    lines = _long_lines(texts, min_chars)
    often = lines.groupBy(*KEYS).agg(F.count("*").alias("n"))
    often = materialise(often.where(F.col("n") >= min_docs), "often", folder)
    total = often.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = materialise(join_totals(lines, often, KEYS, total, folder, "counted", "inner"), "found", folder)
    holders = found.where("doc_id is not null").select(*KEYS, "doc_id").distinct()
    shared = holders.groupBy(*KEYS).agg(F.count("*").alias("docs"), F.max("doc_id").alias("last")).where(F.col("docs") >= min_docs)
    shared = shared.join(often.select(*KEYS, "n"), KEYS).select(*KEYS, "last", "n")
    return join_totals(found, shared, KEYS, total, folder, "shared", "inner").where(~F.col("doc_id").eqNullSafe(F.col("last"))).select(*DOC, "at")


def _mask(positions: Column) -> Column:
    """Sorted positions as bytes: 1 at a dropped position, 0 before it."""
    before = F.transform(positions, lambda p, i: F.concat(
        F.repeat(F.lit("0"), p - F.when(i > 0, F.get(positions, i - 1)).otherwise(F.lit(-1)) - 1), F.lit("1")))
    return F.array_join(before, "").cast("binary")


def _positions(dropped: DataFrame) -> DataFrame:
    """One row for each text that loses lines: its mask and their number."""
    gathered = dropped.groupBy(*DOC).agg(F.sort_array(F.collect_set("at")).alias("places"))
    return gathered.select(*[F.col(c).alias(f"__{c}") for c in DOC], F.size("places").cast("long").alias("n_dropped"), _mask(F.col("places")).alias("mask"))


def line_dedup(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text for each row of ``docs`` (columns
    doc_id, text)."""
    folder = scratch(docs.sparkSession, "line-dedup")
    texts = _texts(docs)
    positions = materialise(_positions(dropped_lines(texts, min_chars, min_docs, folder)), "positions", folder)
    right = F.broadcast(positions) if broadcast_bytes(positions) <= BROADCAST_BYTES else positions
    joined = texts.join(right, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in DOC], "left")
    lines = lines_of(F.col("text"))
    stays = F.filter(lines, lambda line, i: F.coalesce(F.substring("mask", i + 1, F.lit(1)) != F.lit(b"1"), F.lit(True)))
    kept = F.when(F.col("n_dropped").isNull(), F.col("text")).otherwise(F.array_join(stays, "\n"))
    return joined.select("doc_id", F.size(lines).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
                         kept.alias("kept_text"))


def line_digests(docs: DataFrame, **options) -> DataFrame:
    """``line_dedup`` with the SHA-256 of the kept text in its place."""
    found = line_dedup(docs, **options)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
