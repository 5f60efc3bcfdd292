"""Jaccard join on word shingles by parity sketches.

Every document has the set of its distinct 3-word shingles. Its parity sketch
has a bit for each of d hash places; each shingle flips its place's bit, so
two sketches differ in at most as many bits as the sets differ in shingles.

Two sets of a and b shingles with Jaccard >= t differ in at most
(a + b)(1 - t)/(1 + t) shingles. Sizes are cut into bands; a band has K, the
most that a pair whose larger set lies in it can differ in, and cuts the
sketch into K + 1 parts. K differences cannot touch all of them (pigeonhole),
so every linked pair has an equal part. A document emits its parts' keys in
its own band, and in the next one if it is large enough to be the smaller
partner there. Documents that share a key are compared.

A key must tell more documents apart than there are, or unrelated ones meet by
chance: of n rows, it needs log2(n) + ``SLACK_BITS`` bits. So parts are that many
bits' worth of places wide (only the odd ones are ever held), and one odd bit
says enough. As that may be a phrase that many documents use, a part with fewer
than ``ODD_BITS`` is joined with parts that follow, and there are E parts more
than K + 1 so that empty ones can be left out. No link is lost:

- Let part i differ in d_i bits, K at most in all. In a ring, the K + 1 + E
  numbers 1 - d_i sum up to 1 + E or more, so there are at least 1 + E places
  from which on all partial sums are 1 or more (cycle lemma). At such a place
  the part is equal, the next one differs in one bit at most, and the next two
  in two at most: of two halves of the next one is equal, and of three thirds
  of the one after it one is.
- A document with at most E empty parts emits nothing at these. At most E of a
  pair's places are lost by that, so one is left, at a part that is not empty.
- A part with enough odd bits is a key. Another emits two, each with a half of
  the next part, and where such a key still has too few, three in its place,
  each with a third of the part after that. What is equal on both sides decides
  which.

Equal sets are put together first, so a text with any number of copies is one
member. Within a bucket (the members that share a key) not all pairs are
compared:

- A bucket of up to eight members is its pairs, but for connected ones.
- A larger one is first rid of members that sizes and short sketches let be
  linked with no other of up to a thousand that meet the same head: a passage
  that unlike documents share costs no sets and no differences.
- The members of a larger one are compared with its head; up to a thousand are
  counted against each other in a task, by their differences from the head.
- The members of one that is larger still are described by their differences E(x) = x xor p from a pivot p: the set of what more than
  half of the head's members have. x xor y = E(x) xor E(y), so with
  q = (1 - t)/(1 + t) two are linked iff |E(x) xor E(y)| <= q (|x| + |y|).
  Let f(x) = |E(x)| - q |x|. If f(x) + f(y) <= 0 they are linked, and then
  both are linked with the member of least f, which is all that is noted.
  Else a linked pair shares at least (|E(x)| + |E(y)| - K) / 2 elements, with
  K the most that it may differ in. In any one order of the elements, the one
  with the smaller E then has a shared element among its first K/2 + 1, and
  the other has it among its first K + 1 (prefix filter). The order is by
  rarity among the members, so these are mostly elements that nobody shares.
  Up to a thousand members that meet in an element are counted against each
  other in a task, on their short differences; more are a bucket of the next
  round, with a pivot of its own. Then every element is had by half of the
  bucket at most, so buckets shrink. Where the next buckets would be more rows
  than the pairs of the bucket's blocks (of half a task), or hold more than
  three quarters of it, those pairs of blocks are compared instead.

Rounds end when no bucket is left that holds two components. No link between
different components is missed, and what a round moves is proportional to the
members' differences, not to pairs. Verification compares the sets themselves.

Texts: A-Z in lower case, words ``[^\\x20\\x09-\\x0D]+``; of fewer than three
words the whole sequence is the one shingle; without words the set is empty
and linked with nothing. Rows that share a doc_id are one document to the
links. Rows without doc_id are linked with nothing and have no component. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_BYTES, broadcast_bytes, join_totals, materialise, release_memory, released, scratch

BAND_RATIO = 1.4
SLACK_BITS = 10
ODD_BITS = 2
SPARE_PARTS = 0.15  # E is this share of K + 1, and MORE_PARTS
MORE_PARTS = 3
SMALL_BUCKET = 8
TASK_BUCKET = 1000
ROWS_PER_CALL = 4_000
MASK = np.uint64(0xFFFFFFFFFFFFFFFF)

# --- shingles ---------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finisher of a common 64-bit generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = 0xD1342543DE82EF95  # odd


def _powers(n: int) -> np.ndarray:
    """_STEP ** i modulo 2**64, by doubling."""
    out = np.ones(n, dtype=np.uint64)
    filled = 1
    while filled < n:
        take = min(filled, n - filled)
        out[filled:filled + take] = out[:take] * np.uint64(pow(_STEP, filled, 1 << 64))
        filled += take
    return out


_POWERS = _powers(256)


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash for each word, in order."""
    raw = np.frombuffer(text, dtype=np.uint8)
    inside = ~_IS_SPACE[raw]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.zeros(0, dtype=np.uint64)
    first = np.ones(len(at), dtype=bool)
    first[1:] = np.diff(at) > 1
    starts = np.flatnonzero(first)
    lengths = np.diff(np.append(starts, len(at)))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    powers = _POWERS if lengths.max() <= len(_POWERS) else _powers(int(lengths.max()))
    sums = np.add.reduceat(_BYTE[raw[at]] * powers[place], starts)
    return _mix(sums + lengths.astype(np.uint64))


def shingle_set(text: str | None, width: int = 3) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    words = word_hashes((text or "").encode())
    if not len(words):
        return words
    n = len(words) - width + 1
    if n < 1:
        total = np.array([len(words)], dtype=np.uint64)
        for j in range(len(words)):
            total = _mix(total * np.uint64(_STEP) + words[j:j + 1])
        return total
    total = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        total = _mix(total * np.uint64(_STEP) + words[j:j + n])
    return np.unique(total)


# --- bands and keys ---------------------------------------------------------


class Bands:
    """Size bands for links of Jaccard >= percent / 100, in whole numbers."""

    def __init__(self, percent: int):
        self.percent = percent

    def band(self, n: int) -> int:
        b = max(0, int(np.log(n) / np.log(BAND_RATIO)) - 1)
        while self.low(b + 1) <= n:
            b += 1
        return b

    def low(self, band: int) -> int:
        """The smallest size in a band."""
        return int(np.ceil(BAND_RATIO**band - 1e-9)) if band else 1

    def most(self, band: int) -> int:
        """The most that a linked pair can differ in whose larger set is in
        the band. intersection >= p/100 union and union + intersection = a + b
        give difference <= (a + b)(100 - p)/(100 + p), with a, b below the
        next band's start."""
        top = max(self.low(band), self.low(band + 1) - 1)
        return 2 * top * (100 - self.percent) // (100 + self.percent)

    def of(self, n: int) -> list[int]:
        own = self.band(n)
        out, up = [own], own + 1
        # the smaller of two linked sets has at least p/100 of the larger
        while 100 * n >= self.percent * self.low(up):
            out.append(up)
            up += 1
        return out


def bits_needed(rows: int) -> float:
    return float(np.log2(max(rows, 1))) + SLACK_BITS


def band_keys(shingles: np.ndarray, band: int, bands: Bands, need: float) -> np.ndarray:
    """The keys that a set emits in a band."""
    most = bands.most(band)
    spare = int(np.ceil(SPARE_PARTS * (most + 1))) + MORE_PARTS if most else 0
    parts = most + 1 + spare
    width = 6 * int(np.ceil(2**need / 6))  # halves and thirds are whole
    place, flips = np.unique(_mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)) % np.uint64(width * parts), return_counts=True)
    odd = place[flips % 2 == 1]
    tag = _mix(np.array([(band << 32) + parts], dtype=np.uint64))[0]
    seal = _mix((odd + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + tag)
    by_half, by_third = np.zeros((parts, 2), dtype=np.uint64), np.zeros((parts, 3), dtype=np.uint64)
    half = (odd // np.uint64(width // 2)).astype(np.int64)
    np.bitwise_xor.at(by_half.reshape(-1), half, seal)
    np.bitwise_xor.at(by_third.reshape(-1), (odd // np.uint64(width // 3)).astype(np.int64), seal)
    by_part = by_half[:, 0] ^ by_half[:, 1]
    n_half = np.bincount(half, minlength=parts * 2).reshape(parts, 2)
    n_part = n_half.sum(axis=1)
    number = np.arange(parts, dtype=np.uint64) * np.uint64(16)
    full = (n_part >= ODD_BITS) | (parts == 1)  # one part is the whole sketch
    keys = [_mix(by_part[full] + _mix(number[full] + tag))]
    empty = n_part == 0
    at = np.flatnonzero(~full & ~empty if empty.sum() <= spare else ~full)
    if len(at):
        own = _mix(by_part[at] + tag)
        one, two = (at + 1) % parts, (at + 2) % parts
        for h in range(2):
            longer = _mix(own + by_half[one, h] + _mix(number[at] + np.uint64(1 + h) + tag))
            short = n_part[at] + n_half[one, h] < ODD_BITS
            keys.append(longer[~short])
            for t in range(3):
                keys.append(_mix(longer[short] + by_third[two[short], t] + np.uint64(4 + t)))
    return np.concatenate(keys)


def keys_of(shingles: np.ndarray, bands: Bands, need: float = bits_needed(1 << 20)) -> np.ndarray:
    return np.concatenate([band_keys(shingles, b, bands, need) for b in bands.of(len(shingles))]).view(np.int64)


# --- a filter of fixed size over keys ----------------------------------------

FILTER_BITS = 1 << 27
SEGMENT_BITS = 1 << 16


# A key has two bits: of the filter's n keys, n / FILTER_BITS squared (times
# four) of all others pass it, where one bit lets n / FILTER_BITS pass.
FILTER_SHIFTS = (0, 13)


def _hits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a filter holds (and a few more that it does not)."""
    found = np.ones(len(keys), dtype=bool)
    for shift in FILTER_SHIFTS:
        at = ((keys.view(np.uint64) >> np.uint64(shift)) % np.uint64(FILTER_BITS)).astype(np.int64)
        found &= ((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)
    return found


def _key_filter(keys: DataFrame) -> bytes:
    """A bitmap of FILTER_BITS / 8 bytes, whatever the input; it comes to the
    driver as segments."""
    # FILTER_BITS is a power of two: the low bits of the key, and of the key shifted
    places = F.array(*[F.pmod(F.shiftrightunsigned("key", shift), F.lit(FILTER_BITS)) for shift in FILTER_SHIFTS])
    segments = (keys.select(F.explode(places).alias("at"))
                .select((F.col("at") / SEGMENT_BITS).cast("int").alias("segment"), (F.col("at") % SEGMENT_BITS).cast("int").alias("bit"))
                .groupBy("segment").applyInPandas(_segment, "segment int, bits binary"))
    have = {r.segment: bytes(r.bits) for r in segments.collect()}
    bits = b"".join(have.get(i, bytes(SEGMENT_BITS // 8)) for i in range(FILTER_BITS // SEGMENT_BITS))
    del have
    release_memory()
    return bits


def _segment(rows: pd.DataFrame) -> pd.DataFrame:
    bits = np.zeros(SEGMENT_BITS, dtype=np.uint8)
    bits[rows["bit"].to_numpy()] = 1
    return pd.DataFrame({"segment": [int(rows["segment"].iloc[0])], "bits": [np.packbits(bits).tobytes()]})


def _pass_keys(bitmap, width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            held = [x or b"" for x in batch.column(1).to_pylist()]
            keys = _unpacked(b"".join(held), width).view(np.int64)
            owner = np.repeat(np.arange(len(held)), [len(x) // width for x in held])
            hit = _hits(bits, keys)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner[hit])), pa.array(keys[hit])], ["print", "key"])

    return work


# --- keys that occur twice ----------------------------------------------------

ROWS_PER_OWNER = 12_500
KEYS_PER_RUN = 1_000_000
KEYS_PER_ROW_BITS = 9  # a document has some hundred keys
KEY_SLACK_BITS = 12


def key_width(rows: int) -> int:
    """Bytes of a key as it is kept: enough that few of all keys are equal by
    chance (those are compared in vain), at most seven."""
    return min(7, int(np.ceil((np.log2(max(rows, 2)) + KEYS_PER_ROW_BITS + KEY_SLACK_BITS) / 8)))


def _packed(values: np.ndarray, width: int) -> bytes:
    """Unsigned numbers as ``width`` bytes each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), dtype=np.uint8)
    out[:, :width] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, width)
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _kept_keys(keys: np.ndarray, width: int) -> bytes:
    """The first ``width`` bytes of the keys, each once."""
    return _packed(np.unique(keys.view(np.uint64) >> np.uint64(64 - 8 * width)), width)


def _send_keys(owners: int, width: int):
    """A task's keys in sorted runs of bounded size, each cut by owner, as gaps
    of as few bytes as the widest one needs. A key that a run holds twice has a
    gap of zero."""
    starts = np.array([(o << (8 * width)) // owners for o in range(owners)], dtype=np.uint64)

    def messages(held: list[bytes]) -> pa.RecordBatch:
        keys = _unpacked(b"".join(held), width)
        keys.sort()
        out = []
        for owner, part in enumerate(np.split(keys, np.searchsorted(keys, starts[1:]))):
            if len(part):
                gaps = np.diff(part - starts[owner], prepend=np.uint64(0))
                size = max(1, -(-int(gaps.max()).bit_length() // 8))
                out.append((owner, size, _packed(gaps, size)))
        owner, size, gaps = zip(*out, strict=True) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(owner, pa.int32()), pa.array(size, pa.int32()), pa.array(gaps, pa.binary())],
                                          ["owner", "size", "gaps"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for x in batch.column(0).to_pylist():
                held.append(x or b"")
                n += len(held[-1])
            if n >= KEYS_PER_RUN * width:
                yield messages(held)
                held, n = [], 0
        if held:
            yield messages(held)

    return work


def _twice(owners: int, width: int):
    """The keys that an owner gets twice."""

    def work(messages: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([np.cumsum(_unpacked(g, n), dtype=np.uint64) for n, g in zip(messages["size"], messages["gaps"], strict=True)])
        keys.sort()
        start = (int(messages["owner"].iloc[0]) << (8 * width)) // owners
        found = np.unique(keys[1:][keys[1:] == keys[:-1]]).astype(np.int64) + start
        del keys
        release_memory()
        return pd.DataFrame({"key": found})

    return work


# --- the join ---------------------------------------------------------------


def _sketch(percent: int, width: int, need: float, key_bytes: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            sizes, prints, keys, short = [], [], [], []
            for text, named in zip(batch.column(1).to_pylist(), batch.column(0).is_valid().to_pylist(), strict=True):
                s = shingle_set(text, width)
                sizes.append(len(s))
                prints.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                keys.append(_kept_keys(keys_of(s, bands, need), key_bytes) if len(s) and named else None)
                short.append(_short_sketch(s))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.binary()),
                 pa.array(short, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "print", "keys", "sketch"])

    return work


SHORT_SKETCH = 512
WIDE_SKETCH = 4096  # for the pairs that are left: tells long sets apart too


def _short_sketch(shingles: np.ndarray, places: int = SHORT_SKETCH) -> np.ndarray:
    """The parity sketch of ``places`` places, as 64-bit words."""
    counts = np.bincount((_mix(shingles) % np.uint64(places)).astype(np.int64), minlength=places)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _possible(pairs: DataFrame, short: DataFrame, percent: int, places: int = SHORT_SKETCH) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out: the Hamming
    distance of two sketches is no more than the sets differ in. Only these
    pairs' sets are shipped."""
    def side(node: str) -> DataFrame:
        return short.select(F.col("node").alias(node), F.col("n").alias(f"n_{node}"), F.col("sketch").alias(f"s_{node}"))

    near = pairs.join(side("a"), "a").join(side("b"), "b")
    total = F.col("n_a") + F.col("n_b")
    words = [F.bit_count(F.get("s_a", F.lit(i)).bitwiseXOR(F.get("s_b", F.lit(i)))) for i in range(places // 64)]
    return near.where((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                      & ((100 + percent) * sum(words[1:], words[0]) <= (100 - percent) * total)).select("a", "b").distinct()


def _with_partners(buckets: DataFrame, short: DataFrame, percent: int, folder: str) -> DataFrame:
    """The rows (node, key) of large buckets without the members that cannot be
    linked with any other. The members of all buckets that have a head are held
    against each other by sizes and short sketches, in a task if there are up
    to TASK_BUCKET of them; of more, all stay."""
    heads = buckets.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(1)).alias("h"), "node")).alias("p"))
    placed = materialise(buckets.join(heads.select("key", F.col("p.node").alias("g")), "key"), "placed", folder)
    met = materialise(placed.select("g", "node").distinct(), "met", folder)
    sizes = met.groupBy("g").agg(F.count("*").alias("n"))
    n = met.count()
    groups = materialise(join_totals(met, sizes.select("g", "n", F.col("n").alias("m")), ["g"], n, folder, "group-sizes", "inner"), "groups", folder)
    calls = max(16, -(-n // ROWS_PER_CALL))
    fit = groups.where(F.col("m") <= TASK_BUCKET).join(short, "node").select(
        "g", "node", "n", "sketch", F.pmod(F.xxhash64("g"), F.lit(calls)).alias("call"))
    kept = fit.groupBy("call").applyInPandas(_partners(percent), "g long, node long")
    stay = groups.where(F.col("m") > TASK_BUCKET).select("g", "node").union(kept)
    return placed.join(stay, ["g", "node"], "left_semi").select("node", "key")


def _partners(percent: int):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("g", kind="stable")
        g, sizes = rows["g"].to_numpy(), rows["n"].to_numpy()
        bits = np.unpackbits(np.array(rows["sketch"].to_list(), dtype=np.int64).view(np.uint8), axis=1)
        keep = np.zeros(len(g), dtype=bool)
        cuts = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1).tolist(), len(g)]
        for i, j in zip(cuts, cuts[1:], strict=False):
            b, n = bits[i:j].astype(np.float32), sizes[i:j]  # whole numbers up to SHORT_SKETCH: exact
            odd = b.sum(axis=1)
            differ = odd[:, None] + odd[None, :] - 2 * (b @ b.T)
            may = (100 + percent) * differ <= (100 - percent) * (n[:, None] + n[None, :])
            may &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
            np.fill_diagonal(may, False)
            keep[i:j] = may.any(axis=1)
        out = rows.loc[keep, ["g", "node"]]
        release_memory()
        return out

    return work


def _sets(width: int, bitmap):
    """The sets of the documents whose id is in the filter, and their wide sketches."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, dtype=np.uint8)
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            batch = batch.filter(pa.array(_hits(bits, ids) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)))
            sets = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_short_sketch(s, WIDE_SKETCH) for s in sets], pa.list_(pa.int64())),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "n", "sketch", "shingles"])

    return work


def _verify(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = np.concatenate([a, b])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                ok.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return work


def components(nodes: DataFrame, links: DataFrame, folder: str) -> DataFrame:
    """(node, root): the smallest node reachable. ``links`` (a, b).

    Every round each node takes the smallest root among its own and its
    neighbours', then its root's root; both are joins of narrow rows."""
    both = materialise(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links", folder)
    # only linked nodes take part in the rounds
    state = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "root-0", folder)
    i = 0
    while True:
        i += 1
        near = both.join(state.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        # a root is told the smallest value that any of its nodes has seen
        seen = state.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        told = seen.groupBy(F.col("root").alias("told")).agg(F.min("low").alias("new"))
        nxt = seen.join(told, F.col("root") == F.col("told")).select("node", F.least("low", "new").alias("next"), "root")
        nxt = materialise(nxt, f"root-{i}", folder)
        changed = nxt.where("next <> root").limit(1).count()
        state = nxt.select("node", F.col("next").alias("root"))
        if not changed:
            break
    return nodes.join(state, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def _heads(open_: DataFrame, seed: int) -> DataFrame:
    """(key, p): a member of each bucket, the same one for many buckets of
    like members, as it is the least by one hash."""
    return open_.groupBy("key").agg(F.min(F.struct(F.xxhash64("node", F.lit(seed)).alias("h"), "node", "root")).alias("p"))


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, x, y): the two sets beside each of the (written) pairs. Pairs go
    to the sets of a if their measured bytes allow it; only sets of some b are
    dealt by b."""
    few = broadcast_bytes(pairs) <= BROADCAST_BYTES
    with_a = (F.broadcast(pairs) if few else pairs).join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
    wanted = pairs.select(F.col("b").alias("node")).distinct()
    met = sets.join(F.broadcast(wanted) if few else wanted, "node", "left_semi").select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return with_a.join(met, "b").select("a", "b", "x", "y")


def _links(pairs: DataFrame, sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """The (written) pairs that are linked, by the sets of those that their wide
    sketches do not rule out."""
    near = materialise(_possible(pairs, sets.select("node", "n", "sketch"), percent, WIDE_SKETCH), "near-pairs", folder)
    return _with_sets(near, sets).mapInArrow(released(_verify(percent)), "a long, b long")


def _with_heads(spokes: DataFrame, sets: DataFrame, folder: str) -> DataFrame:
    """``_with_sets`` of distinct pairs (a, b) whose a are few: their sets are
    broadcast if their measured bytes allow it, and so are the (written) pairs:
    then b's sets stay where they are."""
    few = broadcast_bytes(spokes) <= BROADCAST_BYTES
    ids = spokes.select(F.col("a").alias("node")).distinct()
    heads = materialise(sets.join(F.broadcast(ids) if few else ids, "node", "left_semi"), "head-sets", folder)
    side = heads.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    side = F.broadcast(side) if broadcast_bytes(heads) <= BROADCAST_BYTES else side
    with_b = (F.broadcast(spokes) if few else spokes).join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
    return with_b.join(side, "a").select("a", "b", "x", "y")


def _deltas(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_p, size, linked, delta = [], [], [], []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                e = np.setxor1d(a, b, assume_unique=True)
                size_p.append(len(a))
                size.append(len(b))
                linked.append((100 + percent) * len(e) <= (100 - percent) * (len(a) + len(b)))
                delta.append(e.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size_p, pa.int64()), pa.array(size, pa.int64()), pa.array(linked, pa.bool_()),
                 pa.array(delta, pa.list_(pa.int64()))], ["p", "node", "size_p", "size", "linked", "e"])

    return work


def _pivot_round(many: DataFrame, sets: DataFrame, percent: int, seed: int, folder: str) -> tuple[DataFrame, DataFrame]:
    """(links, next buckets) of the larger buckets, as the module says."""
    heads = _heads(many, seed).select("key", F.col("p.node").alias("a"))
    # g: what shares a pivot; from the second round on a bucket of its own, or
    # the buckets that it was narrowed to would be one again
    group = F.col("a") if seed == 1 else F.col("key")
    met = materialise(many.join(heads, "key").where("node <> a").select(group.alias("g"), "a", F.col("node").alias("b")).distinct(), "met", folder)
    star = _with_heads(materialise(met.select("a", "b").distinct(), "spokes", folder), sets, folder).mapInArrow(
        released(_deltas(percent)), "p long, node long, size_p long, size long, linked boolean, e array<long>")
    if seed > 1:
        star = star.join(met.select("g", F.col("a").alias("p"), F.col("b").alias("node")), ["p", "node"])
    else:
        star = star.withColumn("g", F.col("p"))
    star = materialise(star, "star", folder)
    links = star.where("linked").select(F.col("p").alias("a"), F.col("node").alias("b")).distinct()
    counts = star.groupBy("g").agg(F.count("*").alias("m"), F.min("p").alias("p"), F.min("size_p").alias("size_p"))
    counts = materialise(counts, "groups", folder)
    roots = materialise(many.groupBy("node").agg(F.min("root").alias("root")), "roots", folder)
    none = F.array().cast("array<long>")
    # groups that fit a task are one bucket each; a member's differences are sent once
    placed = join_totals(star, counts.select("g", F.col("m").alias("n"), "m"), ["g"], star.count(), folder, "placed", "inner")
    whole = placed.where(F.col("m") < TASK_BUCKET).select("g", "node", "size", "e").union(
        counts.where(F.col("m") < TASK_BUCKET).select("g", F.col("p").alias("node"), F.col("size_p").alias("size"), none))
    whole = whole.join(F.broadcast(roots) if broadcast_bytes(roots) <= BROADCAST_BYTES else roots, "node")
    links = links.union(_in_calls(whole.withColumn("met", F.lit(0).cast("long")), counts.agg(F.coalesce(F.sum("m"), F.lit(0))).first()[0], percent))
    counts = counts.where(F.col("m") >= TASK_BUCKET)
    if not counts.limit(1).count():
        return links, many.select("node", "key").limit(0)
    star = placed.where(F.col("m") >= TASK_BUCKET).drop("m")
    # move the pivot to what most of its members have; the head is a member too
    usual = (star.select("g", F.explode("e").alias("e")).groupBy("g", "e").agg(F.count("*").alias("n"))
             .join(counts, "g").where("2 * n > m + 1").groupBy("g").agg(F.collect_list("e").alias("usual")))
    counts = counts.join(usual, "g", "left").select("g", "p", "size_p", F.coalesce("usual", none).alias("usual"))
    members = star.select("g", "node", "size", "e").union(
        counts.select("g", F.col("p").alias("node"), F.col("size_p").alias("size"), none.alias("e")))
    members = members.join(counts.select("g", "usual"), "g").select(
        "g", "node", "size", F.concat(F.array_except("e", "usual"), F.array_except("usual", "e")).alias("e"))
    members = materialise(members.join(roots, "node"), "members", folder)
    # f in whole numbers: times (100 + percent)
    f = (100 + percent) * F.size("e") - (100 - percent) * F.col("size")
    low = members.groupBy("g").agg(F.min(F.struct(f.alias("f"), "node")).alias("low"))
    implied = members.select("g", "node", f.alias("f")).join(low, "g").where("node <> low.node and f + low.f <= 0").select(
        F.col("low.node").alias("a"), F.col("node").alias("b"))
    # prefixes by rarity; elements that no other member has take up places
    elements = members.select("g", "node", F.explode("e").alias("e"))
    seen = elements.groupBy("g", "e").agg(F.count("*").alias("n")).where("n > 1")
    shared = elements.join(seen, ["g", "e"]).groupBy("g", "node").agg(F.sort_array(F.collect_list(F.struct("n", "e"))).alias("common"))
    most = F.floor((100 - percent) * F.col("size") / percent).cast("int")  # the most that x can differ in from a linked set
    place = F.col("at") + F.col("alone")
    chosen = (members.join(shared, ["g", "node"])
              .select("g", "node", "root", most.alias("most"), (F.size("e") - F.size("common")).alias("alone"), F.posexplode("common").alias("at", "c"))
              .where(place <= F.col("most")).select("g", "c.e", "node", "root", (place <= F.floor(F.col("most") / 2)).alias("first")))
    useful = chosen.groupBy("g", "e").agg(
        F.count("*").alias("n"), F.max("first").alias("first"), F.min("root").alias("r0"), F.max("root").alias("r1")).where("first and r0 < r1")
    chosen = materialise(chosen.join(useful.select("g", "e", "n"), ["g", "e"]), "chosen", folder)
    # groups whose large buckets hardly narrow them, or are more rows than the
    # group's pairs of blocks
    large = chosen.where(F.col("n") > TASK_BUCKET)
    sizes = members.groupBy("g").agg(F.count("*").alias("rows"), F.countDistinct("node").alias("nodes")).withColumn(
        "blocks", F.ceil(F.col("rows") / max(1, TASK_BUCKET // 2)))
    wide = materialise(large.groupBy("g").agg(F.count("*").alias("over"), F.max("n").alias("widest")).join(sizes, "g")
                       .where("over >= rows * blocks or 4 * widest > 3 * nodes").select("g", "blocks"), "wide", folder)
    small = chosen.where(F.col("n") <= TASK_BUCKET).select("g", F.col("e").alias("met"), "node", "root")
    left = large.join(wide, "g", "left_anti").select("node", F.xxhash64("g", "e").alias("key"))
    if seed == 1:  # the links of this round may close them; else they are one bucket of the next
        left = left.union(members.join(wide, "g", "left_semi").select("node", F.xxhash64("g").alias("key")))
    else:
        block = F.pmod(F.xxhash64("node", F.lit(seed)), F.col("blocks"))
        met_blocks = members.join(wide, "g").select("g", "node", "root", "blocks", block.alias("own"), F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
        small = small.join(wide, "g", "left_anti").unionByName(met_blocks.select(
            "g", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other")).alias("met"), "node", "root"))
    inside = _in_calls(small.join(members.select("g", "node", "size", "e"), ["g", "node"]), small.count(), percent)
    return links.union(implied).union(inside), left.distinct()


def _in_calls(rows: DataFrame, n: int, percent: int) -> DataFrame:
    """Links among the members of each bucket (g, met); ``rows`` (about n): g,
    met, node, root, size, e. Many small buckets make one call, of bounded size."""
    calls = max(16, -(-n // ROWS_PER_CALL))
    called = rows.select("g", "met", "node", "root", "size", "e", F.pmod(F.xxhash64("g", "met"), F.lit(calls)).alias("call"))
    return called.groupBy("call").applyInPandas(_inside(percent), "a long, b long").distinct()


def _bucket_links(node, root, sizes, deltas, percent: int) -> Iterator[tuple[int, int]]:
    """Links that join components among the members of one bucket: the pairs
    are counted here, at most one link a member comes out."""
    m, lengths = len(node), np.array([len(d) for d in deltas])
    element, row = np.concatenate(deltas), np.repeat(np.arange(m), lengths)
    order = np.argsort(element, kind="stable")
    element, row = element[order], row[order]
    common = np.zeros((m, m), dtype=np.int32)
    cuts = np.append(np.append(0, np.flatnonzero(np.diff(element)) + 1), len(element))
    for at in np.flatnonzero(np.diff(cuts) > 1):
        rows = row[cuts[at]:cuts[at + 1]]
        common[np.ix_(rows, rows)] += 1
    differ = lengths[:, None] + lengths[None, :] - 2 * common
    linked = (100 + percent) * differ <= (100 - percent) * (sizes[:, None] + sizes[None, :])
    linked &= root[:, None] < root[None, :]
    of = {r: r for r in root.tolist()}

    def top(r):
        while of[r] != r:
            r = of[r]
        return r

    for i, j in zip(*np.nonzero(linked), strict=True):
        a, b = top(int(root[i])), top(int(root[j]))
        if a != b:
            of[a] = b
            yield int(node[i]), int(node[j])


def _inside(percent: int):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["g", "met"], kind="stable")
        g, met = rows["g"].to_numpy(), rows["met"].to_numpy()
        node, root, sizes, deltas = rows["node"].to_numpy(), rows["root"].to_numpy(), rows["size"].to_numpy(), rows["e"].to_list()
        cuts = [0, *(np.flatnonzero((g[1:] != g[:-1]) | (met[1:] != met[:-1])) + 1).tolist(), len(rows)]
        out = []
        for i, j in zip(cuts, cuts[1:], strict=False):
            if len(set(root[i:j].tolist())) > 1:
                out += _bucket_links(node[i:j], root[i:j], sizes[i:j], deltas[i:j], percent)
        release_memory()
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return work


def jaccard_components(docs: DataFrame, percent: int = 90, width: int = 3) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (the smallest doc_id reachable by links)."""
    spark: SparkSession = docs.sparkSession
    folder = scratch(spark, "parity-join")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = docs.count()
    key_bytes = key_width(n)
    rows = materialise(texts.mapInArrow(released(_sketch(percent, width, bits_needed(n), key_bytes)),
                                        "doc_id long, n_shingles long, print binary, keys binary, sketch array<long>"), "sketches", folder)

    # equal sets: the smallest id stands for all of them
    named = rows.where("doc_id is not null and n_shingles > 0")
    heads = materialise(named.groupBy("print").agg(F.min("doc_id").alias("node"), F.count("*").alias("n")), "heads", folder)

    # Keys that occur twice: tasks send the owners of key ranges their sorted
    # keys as gaps of two or three bytes, the owners answer with what they got
    # twice. A filter of fixed size then picks the few rows that have such
    # keys; only these are shuffled as rows.
    owners = max(8, -(-named.count() // ROWS_PER_OWNER))
    sent = named.select("keys").mapInArrow(released(_send_keys(owners, key_bytes)), "owner int, size int, gaps binary")
    twice = sent.groupBy("owner").applyInPandas(_twice(owners, key_bytes), "key long")
    bitmap = spark.sparkContext.broadcast(_key_filter(materialise(twice, "twice", folder)))
    likely = named.select("print", "keys").mapInArrow(released(_pass_keys(bitmap, key_bytes)), "print binary, key long")
    first = heads.select("print", "node")
    if broadcast_bytes(first) <= BROADCAST_BYTES:  # then only narrow rows are dealt out, and once
        first = F.broadcast(first)
        likely = likely.join(first, "print").select("node", "key").distinct()
    else:
        likely = likely.distinct().join(first, "print").select("node", "key")
    likely = materialise(likely, "likely", folder)
    # a key that a large group of near copies shares is not dealt to one task
    counts = likely.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n")).where("low < high")
    members = materialise(join_totals(likely, counts.select("key", "n", F.col("n").alias("members")), ["key"], likely.count(), folder, "key-counts", "inner"),
                          "members", folder)
    # pairs of small buckets that sizes and short sketches do not rule out; only
    # their sets and those of the large buckets' members are fetched
    short = materialise(named.select("print", "doc_id", F.col("n_shingles").alias("n"), "sketch").join(first, "print")
                        .where("doc_id = node").select("node", "n", "sketch").distinct(), "short", folder)
    small = members.where(F.col("members") <= SMALL_BUCKET)
    pairs = small.select("key", F.col("node").alias("a")).join(small.select("key", F.col("node").alias("b")), "key").where("a < b").select("a", "b")
    pairs = materialise(_possible(pairs.distinct(), short, percent), "first-pairs", folder)
    buckets = materialise(_with_partners(members.where(F.col("members") > SMALL_BUCKET).select("node", "key"), short, percent, f"{folder}/partners"),
                          "buckets", folder)

    nodes = buckets.select("node").union(pairs.select("a")).union(pairs.select("b")).distinct()
    wanted = materialise(nodes, "wanted", folder)
    # a filter again, so that no other text is shuffled
    chosen = spark.sparkContext.broadcast(_key_filter(wanted.select(F.col("node").alias("key"))))
    sets = materialise(texts.mapInArrow(released(_sets(width, chosen)), "node long, n long, sketch array<long>, shingles binary"), "sets", folder)

    links = materialise(_links(pairs, sets, percent, folder), "first-links", folder)
    found = materialise(components(wanted, links, f"{folder}/first"), "found", folder)
    i = 0
    while True:
        i += 1
        here = f"{folder}/round-{i}"
        # members of the buckets that still hold several components
        rooted = materialise(buckets.join(found, "node"), "rooted", here)
        state = rooted.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.count("*").alias("n")).where("r0 < r1")
        open_ = materialise(join_totals(rooted, state.select("key", "n", F.col("n").alias("held")), ["key"], rooted.count(), here, "state", "inner")
                            .select("key", "node", "root", F.col("held").alias("n")), "open", here)
        if not open_.limit(1).count():
            break
        few = open_.where(F.col("n") <= SMALL_BUCKET)
        other = few.select("key", F.col("node").alias("b"), F.col("root").alias("root_b"))
        pairs = few.join(other, "key").where("node < b and root <> root_b").select(F.col("node").alias("a"), "b").distinct()
        more, left = _pivot_round(open_.where(F.col("n") > SMALL_BUCKET), sets, percent, i, here)
        pairs = materialise(_possible(pairs, short, percent), "pairs", here)
        if pairs.limit(1).count():
            more = more.union(_links(pairs, sets, percent, here))
        new = materialise(more, "new", here)
        buckets = materialise(left, "buckets", here)
        links = materialise(links.union(new), "all-links", here)
        if not buckets.limit(1).count():
            break
        found = materialise(components(wanted, links, here), "found", here)

    found = components(wanted, links, f"{folder}/last")
    roots = heads.join(found, "node", "left").select("print", "n", F.coalesce("root", "node").alias("component_id"))
    # a set that a large share of the rows has is not dealt to one task
    narrow = named.select("doc_id", "n_shingles", "print")
    placed = join_totals(narrow, roots, ["print"], narrow.count(), folder, "roots").select("doc_id", "n_shingles", "component_id")
    alone = rows.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone)


def drop_near_copies(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``docs`` with one document of each component (the one the component is
    named after), all its columns. Documents without words or id stay. The ids
    that go are broadcast if their number allows it, so texts stay where they
    are; else both sides are shuffled."""
    found = jaccard_components(docs, percent, width)
    gone = materialise(found.where("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    side = F.broadcast(gone) if broadcast_bytes(gone) <= BROADCAST_BYTES else gone
    return docs.join(side, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
