"""Hierarchical weighted hash tree: rows descend region, rack and shard.

At each node a row draws u in (0, 1) for every child from the hash of its
doc_id and the child's path, and goes to the child with the least
``-ln(u) / weight``: a child gets rows in proportion to its weight, the
weight of an inner node is the sum of its shards', and a draw depends on
nothing but the key and that child's path. So a changed weight moves rows only
into or out of the changed child at each level; siblings below other nodes
keep theirs. Growing by a new region (``grow``) moves rows only into it.

Column functions only; a row costs one draw for each child of the three nodes
on its way, whatever the number of shards. Rows without doc_id are placed by
their text's checksum. Null text has size 16 and the checksum of no bytes.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, unit_draw

ROWS_PER_SLOT_RUN = 65_536


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def layout(regions: int = 5, racks: int = 2, shards: int = 4) -> list[Shard]:
    """An even tree; shards are numbered from 0 through all racks."""
    return [Shard(g, r, (g * racks + r) * shards + s) for g in range(regions) for r in range(racks) for s in range(shards)]


def grow(tree: list[Shard], weight: float = 1.0) -> list[Shard]:
    """One more shard, in a rack and region of its own: every other node keeps
    its weight, so rows move into the new shard only."""
    return [*tree, Shard(max(s.region for s in tree) + 1, 0, max(s.shard for s in tree) + 1, weight)]


def reweigh(tree: list[Shard], shard: int, weight: float) -> list[Shard]:
    return [replace(s, weight=weight) if s.shard == shard else s for s in tree]


def _winner(key: Column, children: dict[int, float], path: str) -> Column:
    """The child of one node that the key's draws choose."""
    scores = [F.struct((-F.log(unit_draw(key, F.lit(f"{path}/{c}"))) / F.lit(float(w))).alias("score"),
                       F.lit(c).alias("child")) for c, w in sorted(children.items()) if w > 0]
    return F.array_min(F.array(*scores))["child"]


def _weights(tree: list[Shard], level: str) -> dict[int, float]:
    out: dict[int, float] = {}
    for s in tree:
        out[getattr(s, level)] = out.get(getattr(s, level), 0.0) + s.weight
    return out


def place(key: Column, tree: list[Shard]) -> Column:
    """The shard of a key: a draw among regions, then among that region's
    racks, then among that rack's shards."""
    region = _winner(key, _weights(tree, "region"), "")

    def among_shards(g: int, r: int) -> Column:
        return _winner(key, _weights([s for s in tree if (s.region, s.rack) == (g, r)], "shard"), f"/{g}/{r}")

    def among_racks(g: int) -> Column:
        here = [s for s in tree if s.region == g]
        racks = [r for r, w in sorted(_weights(here, "rack").items()) if w > 0]
        return F.transform(F.array(_winner(key, _weights(here, "rack"), f"/{g}")),
                           lambda rack: _choose(rack, {r: among_shards(g, r) for r in racks}))[0]

    regions = [g for g, w in sorted(_weights(tree, "region").items()) if w > 0]
    # transform() over one element names the winner, so that it is drawn once
    return F.transform(F.array(region), lambda g: _choose(g, {x: among_racks(x) for x in regions}))[0]


def _choose(value: Column, cases: dict[int, Column]) -> Column:
    items = list(cases.items())
    out = F.when(value == items[0][0], items[0][1])
    for k, v in items[1:]:
        out = out.when(value == k, v)
    return out


def shard_documents(docs: DataFrame, tree: list[Shard]) -> DataFrame:
    """One row for each row of ``docs`` (columns doc_id, text): doc_id, size,
    text_crc32, law, shard, slot, grown_shard.

    Slots number a shard's rows from 0 without gaps. They are counted in runs:
    rows are dealt to runs of bounded size, numbered within the run, and
    shifted by the sizes of the runs before it, so no task sees a whole shard.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    placed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    key = F.coalesce(F.col("doc_id"), -F.col("text_crc32") - 1)
    placed = placed.select("*", place(key, tree).alias("shard"), place(key, grow(tree)).alias("grown_shard"),
                           F.monotonically_increasing_id().alias("row_id"))
    placed = materialise(placed, "placed")  # narrow rows; the texts are read once
    runs = max(16, -(-placed.count() // (len(tree) * ROWS_PER_SLOT_RUN)))
    # by row, not by key: rows that repeat one id spread like any others
    placed = placed.withColumn("run", F.pmod(F.xxhash64("row_id"), F.lit(runs)).cast("int"))
    sizes = placed.groupBy("shard", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "run").orderBy("doc_id", "row_id")) - 1
    return placed.withColumn("within", within).join(offsets, ["shard", "run"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("within") + F.col("offset")).cast("long").alias("slot"), "grown_shard")
