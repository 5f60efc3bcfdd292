"""Inputs shared by the corpus tests."""

from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ["kept", "row_id", "digest", "node", "root", "key", "n", "p", "block", "size", "shard", "slot", "word", "score", "tokens", "norm"]


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def with_clashes(df):
    """Extra columns with names that operators use inside."""
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHES if c not in df.columns])


def edge_rows():
    rng = random.Random(7)
    long_text = " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(400)) for _ in range(30_000))
    return [
        (1, None, "en", "a", None), (2, "", "en", None, 0), (3, " \t\n ", None, "a", 3),
        (4, "one", "en", "a", 3), (5, "one two", "en", "a", 7), (6, "One  two", "en", "b", 8), (7, "one\ttwo", "en", "b", 7),
        (8, long_text, "en", "a", len(long_text)), (9, long_text + " tail", "en", "b", len(long_text) + 5),
        (10, "same words here again and again", "de", "a", 31), (10, "same words here again and again", "de", "a", 31),
        (11, "same words here again and again", "de", "a", 31),
        (None, "same words here again and again", "de", "a", 31), (None, None, None, None, None),
        (None, "a text that only a row without id has", "fr", "c", 37), (12, "Ünïcödé ß 日本語 🙂 Σς", "de", "c", 20),
    ]


def edge_docs(spark):
    return with_clashes(spark.createDataFrame(edge_rows(), SCHEMA))


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(text, width):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} or {tuple(words)}


def components(sets, percent):
    """Smallest id reachable by links, by comparing all pairs that share a
    shingle."""
    ids = sorted(sets)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {i: top(i) for i in ids}
