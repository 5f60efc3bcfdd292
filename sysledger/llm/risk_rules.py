"""Quality rules whose cutoffs keep false rejection below a stated risk.

Every document gets word statistics and from them three scores, higher for
worse: symbols per word character, repeated lines per line, repeated words per
word. For each stratum (language) and each score, cutoffs from the mildest
down are tested on labelled good documents: with n good ones of which k score
above a cutoff, the hypothesis "the cutoff rejects more than ``risk`` of the
good" is rejected if the exact binomial tail P(Bin(n, risk) <= k) is at most
``error`` / (strata x scores). Tests go down the ladder of cutoffs and end at
the first that fails; a fixed sequence needs no correction within itself, and
the division by the number of sequences (Bonferroni) covers the rest. So with
probability 1 - ``error`` no stratum loses more than ``risk`` of its good
documents to any score. Any safe cutoff keeps that promise; the one is taken
that gains most on labelled bad documents, a good one counting as ``price`` bad
ones, so good documents go only where many bad ones do. Strata with fewer labels than could ever pass are
tested together as one pooled stratum, which counts among the sequences; its
cutoffs hold in each of them, and the promise holds for their good documents
taken together. Which strata are pooled depends on label counts only. Where
even the pool is too small, and in strata without any label, there is no
cutoff: nothing is rejected but by the base rule.

Column functions only. Texts are read once; statistics are narrow rows.

Defined cases: a null text has no words; null labels are not used, of several
labels of a document the lowest counts (1 is good, another bad); a null language is a stratum of its
own; rows that repeat are judged each; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, materialise, words

SCORES = ("symbols", "lines", "repeats")
STEPS = 100  # cutoffs are 0.00, 0.01, ... 0.99
WINDOW = 5


def text_statistics(docs: DataFrame, stratum: str = "lang") -> DataFrame:
    """doc_id, stratum, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).cast("string").alias("stratum"),
                    text.alias("text"), words(text).alias("w"))
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    n = F.size("w")
    # the hash of the five words from each place on
    hashes = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(F.col("w"), i + j) for j in range(WINDOW)])))
    d = d.select(
        "doc_id", "stratum", n.cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("text", SPACES, "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.translate(F.col("text"), "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"), hashes.alias("h"))
    # places of windows found twice or more, for the texts that have such
    again = F.when(F.size(F.array_distinct("h")) < F.size("h"),
                   F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("at")))))
    d = d.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), again.alias("s"))
    twice = F.filter("s", lambda e, i: (F.get(F.col("s"), i - 1)["h"] == e["h"]).eqNullSafe(True)
                     | (F.get(F.col("s"), i + 1)["h"] == e["h"]).eqNullSafe(True))
    d = d.select("*", F.sort_array(F.transform(twice, lambda e: e["at"])).alias("starts")).drop("s")
    covered = F.aggregate(
        F.transform("starts", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda total, x: total + x)
    return d.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words")).drop("starts")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def scores() -> dict[str, Column]:
    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    return {"symbols": share("n_symbols", "word_chars"), "lines": share("n_dup_lines", "n_lines"),
            "repeats": share("n_repeat_words", "n_words")}


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), summed in logarithms; k < n."""
    first = n * F.log1p(F.lit(-p))
    odds = F.log(F.lit(p)) - F.log1p(F.lit(-p))

    def add(state: Column, i: Column) -> Column:
        term = state["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(state["total"], term), F.least(state["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    counts = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(counts, F.struct(first.alias("term"), first.alias("total")), add, lambda s: F.exp(s["total"]))


def least_labels(risk: float, each: float) -> int:
    """The fewest good documents that can prove anything: with none above."""
    return math.ceil(math.log(each) / math.log1p(-risk))


def _ladders(rows: DataFrame) -> DataFrame:
    """stratum, score, n, by_step: how many rows need each step of a score; step
    s is the lowest cutoff s / STEPS that the score does not exceed."""
    stepped = rows.select("stratum", F.explode(F.array(*[
        F.struct(F.lit(s).alias("score"), F.least(F.ceil(F.round(F.col(s) * STEPS, 9)), F.lit(STEPS)).cast("int").alias("step"))
        for s in SCORES])).alias("e")).select("stratum", "e.score", "e.step")
    counted = stepped.groupBy("stratum", "score", "step").agg(F.count("*").alias("n"))
    return counted.groupBy("stratum", "score").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("step", "n"))).alias("by_step"))  # at most STEPS + 1 entries


def _above(by_step: str) -> Column:
    """Rows of a ladder whose score exceeds the cutoff of ``step``."""
    return F.aggregate(F.filter(F.map_entries(by_step), lambda e: e["key"] > F.col("step")), F.lit(0).cast("long"),
                       lambda total, e: total + e["value"])


def cutoffs(good: DataFrame, risk: float = 0.02, error: float = 0.05, bad: DataFrame | None = None, price: float = 20.0) -> DataFrame:
    """stratum and one cutoff for each score (null: none is safe), from rows
    of good documents: stratum and a column for each score. Without ``bad``
    (rows of the same form) the lowest safe cutoff is taken, with it the safe
    one that gains most: bad documents above it less ``price`` times the good
    ones; of equal ones the mildest."""
    ladder = materialise(_ladders(good), "ladder")
    each = error / max(1, ladder.count())
    tested = ladder.select(
        "stratum", "score", "n", "by_step",
        F.explode(F.sequence(F.lit(STEPS - 1), F.lit(0), F.lit(-1))).alias("step")).withColumn("k", _above("by_step"))
    # more than the expected share cannot pass; its long sum is not needed
    tail = F.when(F.col("k") <= F.col("n") * risk, binomial_tail(F.col("n"), F.col("k"), risk)).otherwise(F.lit(1.0))
    safe = (tail <= each).cast("int")
    down = Window.partitionBy("stratum", "score").orderBy(F.desc("step"))
    held = tested.withColumn("safe", F.min(safe).over(down)).where("safe = 1")
    if bad is None:
        best = F.min("step")
    else:
        worse = _ladders(bad).select(F.col("stratum").alias("__of"), F.col("score").alias("__score"), F.col("by_step").alias("worse"))
        held = held.join(worse, F.col("stratum").eqNullSafe(F.col("__of")) & (F.col("score") == F.col("__score")), "left")
        gain = F.coalesce(F.when(F.col("worse").isNotNull(), _above("worse")), F.lit(0)) - price * F.col("k")
        best = F.max(F.struct(gain.alias("gain"), "step"))["step"]
    found = held.groupBy("stratum", "score").agg((best / F.lit(float(STEPS))).alias("cutoff"))
    return found.groupBy("stratum").agg(*[F.max(F.when(F.col("score") == s, F.col("cutoff"))).alias(f"{s}_cutoff") for s in SCORES])


def pooled_cutoffs(good: DataFrame, risk: float = 0.02, error: float = 0.05, bad: DataFrame | None = None, price: float = 20.0) -> DataFrame:
    """``cutoffs`` of every stratum; those with too few good rows share the
    ones of their pool."""
    counts = materialise(good.groupBy("stratum").agg(F.count("*").alias("n")), "strata")
    least = least_labels(risk, error / (len(SCORES) * (counts.count() + 1)))
    few = F.col("n") < least
    groups = counts.select(F.col("stratum").alias("__of"), F.struct(few.alias("pooled"), F.when(~few, F.col("stratum")).alias("name")).alias("__group"))

    def grouped(rows: DataFrame) -> DataFrame:
        return rows.join(groups, F.col("stratum").eqNullSafe(F.col("__of"))).select(F.col("__group").alias("stratum"), *SCORES)

    # the sequences are those of the strata with enough rows and of the pool
    found = cutoffs(grouped(good), risk, error, None if bad is None else grouped(bad), price)
    return groups.join(found, F.col("__group").eqNullSafe(F.col("stratum"))).select(
        F.col("__of").alias("stratum"), *[f"{s}_cutoff" for s in SCORES])


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = 0.02, error: float = 0.05,
          price: float = 20.0) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept and the stratum's cutoffs for every row of ``docs``.
    ``labels``: doc_id, quality (1 is good)."""
    stats = materialise(text_statistics(docs, stratum), "text-statistics")
    rows = stats.select("*", base_failed().alias("base_failed"), *[c.alias(s) for s, c in scores().items()])
    marked = (labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.min("quality").alias("quality")))
    holdout = materialise(rows.where("not base_failed").join(marked, "doc_id").select("stratum", "quality", *SCORES), "holdout")
    found = materialise(pooled_cutoffs(holdout.where("quality = 1"), risk, error, holdout.where("quality <> 1"), price), "cutoffs")
    found = found.withColumnRenamed("stratum", "__stratum")
    beyond = F.lit(False)
    for s in SCORES:
        beyond = beyond | F.coalesce(F.col(s) > F.col(f"{s}_cutoff"), F.lit(False))
    joined = rows.join(found, F.col("stratum").eqNullSafe(F.col("__stratum")), "left")
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & ~beyond).alias("kept"), "stratum", *[f"{s}_cutoff" for s in SCORES])
