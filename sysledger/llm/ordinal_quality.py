"""Quality by ordinal regression on graded ratings.

A cumulative-link model: P(grade >= j) = logistic(w.x - t_j) with one weight
vector w shared by all grades and ordered thresholds t_1 < t_2. x is the
hashed text: for each distinct word the word itself and its first four and
five letters, and for the whole text the shares of capitals, symbols, repeated
words, repeated neighbours and repeated lines, each cut into ten steps. Texts
are read whole.

The expected grade is the sum of the tail probabilities P(grade >= j). A
document is kept if its tail probability for the top grade reaches
``keep_tail``, or a lower cut if that would cost good documents: a fifth of
the rated ones is held out of a first fit, and the cut is lowered until no more
than ``good_loss`` of the held-out top grade falls below it. Of fewer held-out
ones than could show such a share (200 at 0.005) none falls below it: with few
ratings the rule errs on the side of keeping. The model that is used is then
fitted on all of them.

The fit takes at most ``max_train`` rated documents (those with the least hash
of the id, so the choice is the same at every run), and of these a share by id
if they have more than ``max_train_ids`` features; only the hashed features
reach the driver. Scoring reads every document in one pass and adds up a
weight for each distinct word.

Defined cases: a null text counts as empty; ratings that are null are not
used, of several ratings of a document the lowest counts; ratings of unknown
documents are ignored; if no more than one grade is rated, nothing can be
learnt and every document is kept with null scores. Rows that repeat are
scored each. Extra columns are ignored (``score``) or kept (``select_rows``).
"""

from __future__ import annotations

import operator
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, release_memory, released, small_batches

WORD = re.compile(r"[^\W\d_]+")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]{2}")
SYMBOLS = "#*$%&|<>!{}[]=~^_"
WORD_CACHE = 200_000


@dataclass(frozen=True)
class Settings:
    dims: int = 1 << 18
    max_train: int = 10_000
    max_train_ids: int = 30_000_000  # hashed features of all of them together
    min_documents: int = 8  # a feature of fewer rated documents gets no weight
    l2: float = 1.0
    iterations: int = 50
    keep_tail: float = 0.5
    good_loss: float = 0.005


def word_features(word: str, dims: int) -> tuple[int, ...]:
    out = [zlib.crc32(b"w " + word.encode()) % dims]
    out += [zlib.crc32(b"p " + word[:k].encode()) % dims for k in (4, 5) if len(word) > k]
    return tuple(out)


def share_features(text: str, found: list[str], distinct: int, dims: int) -> list[int]:
    n = len(found)
    tokens = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    shares = {
        "capitals": len(CAPITALS.findall(text)) / max(1, len(text)) * 4,
        "symbols": sum(map(text.count, SYMBOLS)) / max(1, len(tokens)),
        "distinct": distinct / max(1, n),
        "neighbours": sum(map(operator.eq, tokens, tokens[1:])) / max(1, len(tokens)),
        "lines": 1 - len(set(lines)) / max(1, len(lines)),
        "length": len(str(len(tokens))) / 10,
    }
    return [zlib.crc32(f"s {k} {min(10, int(v * 10))}".encode()) % dims for k, v in shares.items()]


def features(text: str, dims: int) -> np.ndarray:
    found = WORD.findall(text.lower())
    distinct = set(found)
    out = share_features(text, found, len(distinct), dims)
    for word in distinct:
        out += word_features(word, dims)
    return np.array(out, dtype=np.int32)


# --- the model --------------------------------------------------------------


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Model:
    weights: np.ndarray  # float32, one for each hashed feature
    thresholds: np.ndarray  # ascending, one for each grade above the lowest
    grades: int
    cut: float = 0.5  # the least tail probability of the top grade that is kept

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1.. as columns."""
        return _logistic(scores[:, None] - self.thresholds[None, :])


def _minimise(f, x: np.ndarray, iterations: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with halving steps."""
    value, slope = f(x)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        way, used = slope.copy(), []
        for s, y in reversed(moves):
            a = (s @ way) / (s @ y)
            used.append(a)
            way -= a * y
        way *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / max(1.0, np.abs(slope).sum())
        for (s, y), a in zip(moves, reversed(used), strict=True):
            way += s * (a - (y @ way) / (s @ y))
        step = 1.0
        while True:
            nxt = x - step * way
            new_value, new_slope = f(nxt)
            if new_value <= value - 1e-4 * step * (slope @ way) or step < 1e-6:
                break
            step /= 2
        if value - new_value < 1e-5 * abs(value):
            return nxt if new_value <= value else x
        s, y = nxt - x, new_slope - slope
        if s @ y > 1e-10:
            moves = [*moves, (s, y)][-memory:]
        x, value, slope = nxt, new_value, new_slope
    return x


FEATURES_PER_STEP = 500_000


def fit_arrays(rows: list[np.ndarray], grades: np.ndarray, settings: Settings) -> Model | None:
    """Penalised maximum likelihood. Thresholds are t_1 and t_1 plus positive
    gaps, so they stay in order. Beside the rows, only their features' columns
    are held whole; sums over features go by runs of rows."""
    levels = int(grades.max()) + 1 if len(grades) else 0
    if len(np.unique(grades)) < 2:
        return None
    seen = np.zeros(settings.dims, dtype=np.int64)
    for r in rows:
        seen[np.unique(r)] += 1
    used = np.flatnonzero(seen >= min(settings.min_documents, max(2, len(rows) // 50)))
    place = np.full(settings.dims, -1, dtype=np.int32)
    place[used] = np.arange(len(used))
    k, n = len(used), len(rows)
    ends = np.cumsum([0, *[np.count_nonzero(place[r] >= 0) for r in rows]])
    column = np.empty(ends[-1], dtype=np.int32)
    for r, i, j in zip(rows, ends, ends[1:], strict=False):
        column[i:j] = place[r][place[r] >= 0]
    steps = sorted({0, n, *np.searchsorted(ends, range(FEATURES_PER_STEP, ends[-1], FEATURES_PER_STEP)).tolist()})

    def runs() -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Rows, and for each of their features the row (from 0) and column."""
        for i, j in zip(steps, steps[1:], strict=False):
            yield slice(i, j), np.repeat(np.arange(j - i), np.diff(ends[i:j + 1])), column[ends[i]:ends[j]]

    def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
        gaps = np.exp(p[k + 1:])
        t = p[k] + np.concatenate([[0.0], np.cumsum(gaps)])
        s = np.concatenate([np.bincount(at, weights=p[:k][own], minlength=r.stop - r.start) for r, at, own in runs()])
        tail = np.column_stack([np.ones(n), _logistic(s[:, None] - t[None, :]), np.zeros(n)])
        here = np.maximum(tail[np.arange(n), grades] - tail[np.arange(n), grades + 1], 1e-12)
        bend = tail * (1 - tail)
        low, high = bend[np.arange(n), grades] / here, bend[np.arange(n), grades + 1] / here
        by_score = -(low - high)
        by_t = np.zeros((n, levels + 1))
        by_t[np.arange(n), grades] += low
        by_t[np.arange(n), grades + 1] -= high
        by_t = by_t[:, 1:levels].sum(axis=0)
        by_column = np.zeros(k)
        for r, at, own in runs():
            np.add.at(by_column, own, by_score[r][at])
        slope = np.concatenate([
            by_column + settings.l2 * p[:k],
            [by_t.sum()], [by_t[j + 1:].sum() * gaps[j] for j in range(levels - 2)]])
        return float(-np.log(here).sum() + settings.l2 / 2 * (p[:k] @ p[:k])), slope

    p = _minimise(loss, np.concatenate([np.zeros(k), [-2.0], np.zeros(levels - 2)]), settings.iterations)
    weights = np.zeros(settings.dims, dtype=np.float32)
    weights[used] = p[:k]
    return Model(weights, p[k] + np.concatenate([[0.0], np.cumsum(np.exp(p[k + 1:]))]), levels)


def fit_with_cut(rows: list[np.ndarray], grades: np.ndarray, settings: Settings) -> Model | None:
    """The model of all rows with the cut of a model of four fifths of them."""
    model = fit_arrays(rows, grades, settings)
    if model is None:
        return None
    model.cut = settings.keep_tail
    held = np.arange(len(rows)) % 5 == 4
    part = fit_arrays([r for r, h in zip(rows, held, strict=True) if not h], grades[~held], settings)
    good = [r for r, h, g in zip(rows, held, grades, strict=True) if h and g == model.grades - 1]
    if good and part is not None and part.grades == model.grades:
        tails = np.sort(part.tails(np.array([part.weights[r].sum() for r in good]))[:, -1])
        model.cut = min(model.cut, float(tails[int(settings.good_loss * len(good))]))
    return model


def graded(labels: DataFrame) -> DataFrame:
    """Grades from the ratings quality 0/1 and toxic 0/1: 0 for low quality,
    1 for good but toxic, 2 for good. Null ratings drop out."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("toxic") == 0, 2)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))


def fit(docs: DataFrame, ratings: DataFrame, settings: Settings = Settings()) -> Model | None:
    """``ratings``: doc_id, grade (0, 1, ...)."""
    rated = (ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_train))
    # at most max_train rows of two numbers: small enough to go to every task
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(rated), "doc_id").select("doc_id", "grade", "text")
    dims = settings.dims

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t or "", dims) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "grade", "ids"])

    found = materialise(texts.mapInArrow(released(work), "doc_id long, grade int, ids array<int>"), "ratings")
    total = found.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    if total > settings.max_train_ids:  # bounded in bytes too: a share of the rated rows, by their id
        share = int(settings.max_train_ids / total * (1 << 20))
        found = found.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 20)) < share)
    sample = found.select("grade", "ids").toArrow()
    flat = sample.column("ids").combine_chunks()
    rows = [np.asarray(r.values) for r in flat] if len(sample) else []
    model = fit_with_cut(rows, np.asarray(sample.column("grade").to_numpy(), dtype=np.int64), settings)
    del sample, flat, rows
    release_memory()
    return model


class Scorer:
    """Scores texts in a task; a word's weight is looked up once for it."""

    def __init__(self, weights: np.ndarray):
        self.weights, self.dims, self.cache = weights, len(weights), {}

    def _word(self, word: str) -> float:
        value = float(sum(self.weights[i] for i in word_features(word, self.dims)))
        if len(self.cache) >= WORD_CACHE:
            self.cache.clear()
        self.cache[word] = value
        return value

    def score(self, text: str) -> float:
        found = WORD.findall(text.lower())
        distinct = set(found)
        get = self.cache.get
        total = 0.0
        for word in distinct:
            value = get(word)
            total += self._word(word) if value is None else value
        return total + float(self.weights[share_features(text, found, len(distinct), self.dims)].sum())


def _scored(docs: DataFrame, model: Model | None, columns: list[str], only_kept: bool) -> DataFrame:
    """``docs`` (its ``columns``, and the text if that is not one of them) with
    the scores behind them, or its kept rows as they are. Texts are sent once."""
    spark = docs.sparkSession
    small_batches(spark)
    held = spark.sparkContext.broadcast(None if model is None else (model.weights, model.thresholds, model.cut))
    sent = docs.select(*columns, *([] if "text" in columns else ["text"]))
    at = sent.columns.index("text")
    extra = "" if only_kept else ", expected_grade double, tail_probability double, kept boolean"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sent.schema.fields[:len(columns)]) + extra

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None if held.value is None else Scorer(held.value[0])
        for batch in batches:
            texts = batch.column(at).to_pylist()
            own = batch.columns[:len(columns)]
            if scorer is None:
                kept = np.ones(len(texts), dtype=bool)
                grade = top = pa.nulls(len(texts), pa.float64())
            else:
                tails = _logistic(np.array([scorer.score(t or "") for t in texts]).reshape(-1, 1) - held.value[1][None, :])
                grade, top = pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])
                kept = tails[:, -1] >= held.value[2]
            if only_kept:
                yield pa.RecordBatch.from_arrays(own, names=columns).filter(pa.array(kept))
            else:
                yield pa.RecordBatch.from_arrays([*own, grade, top, pa.array(kept)],
                                                 names=[*columns, "expected_grade", "tail_probability", "kept"])

    return sent.mapInArrow(released(work), schema)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, expected_grade, tail_probability and kept for every row."""
    return _scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model, ["doc_id"], False)


def select_rows(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    return _scored(docs, model, docs.columns, True)
