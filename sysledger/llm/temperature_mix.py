"""Mixing sources to target weights by one temperature.

Source i holds the share p_i of all tokens (words) and gets the weight
q_i = p_i^a / sum p_j^a. The exponent a is found by interval section: either
the entropy of q meets ``target_entropy`` (nats), or q is as even as it can be
while no source is repeated more than ``max_repeats`` times within the budget.
Each section evaluates 32 exponents in one aggregate over the sources' totals;
only those 32 rows come to the driver, never the sources.

The weights are realised as block permutations. A source's documents are dealt
to blocks of about ``block_tokens`` tokens, but no fewer than BLOCKS_PER_SOURCE
blocks, by a hash of the id, so that the quota is met to about a thousandth (or
a document, in sources of fewer documents) whatever the source's size. A source with
quota q_i x budget is passed over in whole epochs as often as it fits; in each
epoch its blocks are permuted by a draw of (source, epoch, block). The rest of
the quota is the longest start of one more permuted epoch that does not exceed
it, which a cut on the draw describes. So a document's passes follow from its
own id and one row for its source: no block of texts is ever gathered. The
sum over blocks that finds the cut is made in runs of bounded length.

``place`` in [0, 1) orders the mix: sorted by it, blocks of all sources
interleave, so any start of the sequence has about the target weights.

The budget is ``budget_tokens``, or, if None, the least for which every source
is passed over at least once ("cover"): then nothing is dropped and the
largest factor between sources is ``max_repeats``.

Defined cases: a null text has no tokens; a null source is a source of its
own; a source without tokens is passed over once; documents without doc_id are
dealt by their text; rows that repeat are rows; an empty table gives an empty
mix; other columns are not read by ``mix`` and kept by ``repeat_rows``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, scratch, unit_draw, words

POINTS = 32
ROUNDS = 6
BLOCKS_PER_RUN = 4096
BLOCKS_PER_SOURCE = 1000
SEED = 20240115


def _key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def _source() -> Column:
    return F.struct(F.col("source").isNull().alias("unnamed"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"))


def solve_exponent(totals: DataFrame, total: int, max_repeats: float | None, target_entropy: float | None,
                   budget: float | None) -> float:
    """The exponent; ``totals`` has a row for each source with its tokens.

    The entropy falls and the evenness ends as the exponent grows; the
    greatest repetition falls for exponents from 0 to 1."""
    share = F.col("tokens") / F.lit(float(total))
    low, high = 0.0, 8.0 if target_entropy is not None else 1.0

    def fits(r) -> bool:
        if target_entropy is not None:
            return math.log(r.z) - r.a * r.zlog / r.z <= target_entropy
        repeats = r.most / r.z * budget / total if budget else r.most * r.least
        return repeats <= max_repeats * (1 + 1e-9)

    for _ in range(ROUNDS):
        points = [low + (high - low) * i / POINTS for i in range(POINTS + 1)]
        rows = (totals.where("tokens > 0").select(share.alias("p"), F.explode(F.array(*map(F.lit, points))).alias("a"))
                .groupBy("a").agg(F.sum(F.pow("p", F.col("a"))).alias("z"), F.sum(F.pow("p", F.col("a")) * F.log("p")).alias("zlog"),
                                  F.max(F.pow("p", F.col("a") - 1)).alias("most"), F.max(F.pow("p", 1 - F.col("a"))).alias("least"))
                .orderBy("a").collect())
        ok = [fits(r) for r in rows]
        if ok[0]:
            return low
        if not any(ok):
            if target_entropy is None:
                raise ValueError("the budget alone repeats sources more often than max_repeats")
            return high
        first = ok.index(True)
        low, high = points[first - 1], points[first]
    return high


def plan(docs: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None,
         budget_tokens: int | None = None, block_tokens: int = 65_536, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(sized, sources): the narrow rows doc_id, key, src, tokens; and for
    each source its weight, quota, blocks, whole epochs and the cut."""
    folder = folder or scratch(docs.sparkSession, "mix")
    sized = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _key().alias("key"), _source().alias("src"),
        F.size(words(F.col("text"))).cast("long").alias("tokens")), "sized", folder)
    totals = materialise(sized.groupBy("src").agg(F.sum("tokens").alias("tokens")), "totals", folder)
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    if total:
        a = solve_exponent(totals, total, max_repeats, target_entropy, budget_tokens)
        p = F.col("tokens") / F.lit(float(total))
        raw = F.when(F.col("tokens") > 0, F.pow(p, F.lit(a))).otherwise(0.0)
        z, spread = totals.where("tokens > 0").agg(F.sum(F.pow(p, F.lit(a))), F.max(F.pow(p, F.lit(1 - a)))).first()
        budget = float(budget_tokens) if budget_tokens is not None else total * spread * z
        weight = raw / F.lit(z)
    else:
        a, budget, weight = 1.0, 0.0, F.lit(0.0)
    quota = weight * F.lit(budget)
    whole = F.floor(quota / F.greatest(F.col("tokens"), F.lit(1)) + 1e-9)
    sources = totals.select(
        "src", F.col("tokens").alias("source_tokens"), F.lit(a).alias("exponent"), weight.alias("weight"), quota.alias("quota"),
        F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(BLOCKS_PER_SOURCE)).cast("long").alias("blocks"),
        F.when(F.col("tokens") > 0, whole).otherwise(1).cast("int").alias("epochs"))
    sources = sources.withColumn("rest", F.when(F.col("source_tokens") > 0, F.col("quota") - F.col("epochs") * F.col("source_tokens")).otherwise(0.0))

    # the cut: sum blocks in the order of their draws for the last epoch
    blocks = (sized.join(sources, "src").withColumn("block", block_of())
              .groupBy("src", "block", "blocks", "epochs", "rest").agg(F.sum("tokens").alias("size"))
              .withColumn("u", draw_of(F.col("epochs")))
              .withColumn("run", F.floor(F.col("u") * F.ceil(F.col("blocks") / BLOCKS_PER_RUN)).cast("long")))
    blocks = materialise(blocks, "blocks", folder)
    before = Window.partitionBy("src").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.groupBy("src", "run").agg(F.sum("size").alias("size")).select(
        "src", "run", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("src", "run").orderBy("u", "block").rowsBetween(Window.unboundedPreceding, 0)
    cut = (blocks.withColumn("upto", F.sum("size").over(within)).join(offsets, ["src", "run"])
           .where(F.col("upto") + F.col("offset") <= F.col("rest")).groupBy("src").agg(F.max("u").alias("cut")))
    return sized, materialise(sources.join(cut, "src", "left"), "sources", folder)


def block_of() -> Column:
    return F.pmod(F.xxhash64(F.col("key"), F.lit(SEED)), F.col("blocks"))


def draw_of(epoch: Column) -> Column:
    return unit_draw(F.col("src.unnamed"), F.col("src.name"), epoch.cast("int"), F.col("block"), F.lit(SEED))


def passes() -> Column:
    """The epochs in which a row's block is passed over."""
    n = F.col("epochs") + F.coalesce((draw_of(F.col("epochs")) <= F.col("cut")).cast("int"), F.lit(0))
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """A row for each pass over a document: doc_id, source, n_tokens, weight,
    block, epoch, place."""
    sized, sources = plan(docs, **options)
    rows = sized.join(sources, "src").withColumn("block", block_of())
    rows = rows.select("*", F.explode(passes()).alias("epoch"))
    # a source's passes take the draws from 0 to its epochs and the cut
    place = (F.col("epoch") + draw_of(F.col("epoch"))) / (F.col("epochs") + F.coalesce("cut", F.lit(0.0)) + 1e-12)
    return rows.select(
        "doc_id", F.when(~F.col("src.unnamed"), F.col("src.name")).alias("source"), F.col("tokens").alias("n_tokens"),
        "weight", "block", "epoch", place.alias("place"))


def repeat_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as the mix
    passes over it."""
    _, sources = plan(docs, **options)
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("__row"), _key().alias("key"), _source().alias("src"))
    rows = packed.join(sources, "src").withColumn("block", block_of())
    return rows.select("__row", F.explode(passes())).select("__row.*")
