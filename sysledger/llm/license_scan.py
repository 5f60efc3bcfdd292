"""Licence scan: headers and licence files against templates, then inheritance
by folder.

1. A file's units are its sentences (lines, cut where a sentence ends), its
   paragraphs of several lines (a file's header is one, without its comment
   signs), and, of a licence file, the whole text. Licence files are known by
   name: LICENSE, LICENCE, COPYING, NOTICE, with any extension.
2. A unit is a vector of its words, (1 + ln tf) x idf, with idf over the
   templates: titles, one-line notices, standard headers and whole texts
   (``license_texts``). A word of no template has the mean idf of the
   templates' words. The
   unit's licence is that of the template with the highest cosine, if that
   reaches ``threshold``.
3. An ``SPDX-License-Identifier`` line names its licence itself: the first
   identifier of it that the templates know, without ``-only``, ``-or-later``
   and ``+``.
4. Only units with a licence word (``LICENCE_WORDS``: licence, permission,
   warranty, GPL, CC0 and the like; every template has one) are scored, so that
   the German "mit" is no licence. Texts without any are not cut into units.
5. Units that repeat are scored once; vectors are sparse rows (unit, word).
6. A file's own licence is what an identifier names, or that of its best unit.
   Licence files lend theirs to their folder. A file without an own licence
   takes that of the nearest folder above it that has one: folders, not files,
   are joined with their ancestors.

Column functions only. The templates are a fixed list; what is sent to every
task is made from them alone. A unit that a third of all files hold is one row
after a sum in the scan's tasks, and its licence comes back by a broadcast
(``common.join_totals``).

Defined cases: a null or empty text has no units; a null path is a file at the
root that inherits from the root; ties between templates or licence files go
to the name that sorts last; rows that repeat are files each; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_totals, materialise, scratch
from .license_texts import TEMPLATES

THRESHOLD = 0.65
LICENCE_WORDS = (r"(?i)licen[cs]e|spdx|gpl|creative commons|\bcc[ -]?(?:by|0)|public domain|permission|permitted|redistribut|warrant|copyright"
                 r"|no event|this software")
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
# a word: letters and digits, and dots between digits (2.0)
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
# what comments begin and end lines with
COMMENT = r"(?m)^[ \t]*(?://+|/\*+|\*+/?|#+|--+|;+|%+|<!--+)[ \t]*|[ \t]*(?:\*+/|--+>)[ \t]*$"
SENTENCE_END = r"(?<=[.;!])[ \t]+(?=[A-Z(])"
PARAGRAPH_END = r"\n[ \t\r]*\n"
SPDX = r"(?i)spdx-license-identifier:[ \t]*([^\n]*)"
SPDX_ID = r"[a-z0-9][a-z0-9.-]*"
SPDX_TAIL = r"-only$|-or-later$|[+]$"


class Model:
    """Weights of the templates' words."""

    def __init__(self, templates: list[tuple[str, str]]):
        counts = [(name, Counter(re.findall(WORD, text.lower()))) for name, text in templates]
        df = Counter(w for _, c in counts for w in c)
        n = len(counts)
        self.idf = {w: math.log((n + 1) / (k + 1)) + 0.1 for w, k in sorted(df.items())}
        self.other = sum(k * self.idf[w] for w, k in df.items()) / sum(df.values())
        self.rows: list[tuple[str, int, str, float]] = []  # (word, template, licence, weight of unit length)
        for number, (name, c) in enumerate(counts):
            weights = {w: (1 + math.log(k)) * self.idf[w] for w, k in c.items()}
            norm = math.sqrt(sum(x * x for x in weights.values()))
            self.rows += [(w, number, name, x / norm) for w, x in sorted(weights.items())]
        self.names = {name.lower(): name for name, _ in templates}


def units_of(text: Column, whole: Column) -> Column:
    """The units of a text; ``whole``: whether the text itself is one."""
    bare = F.regexp_replace(text, COMMENT, "")
    sentences = F.flatten(F.transform(F.split(bare, "\n"), lambda line: F.split(line, SENTENCE_END)))
    paragraphs = F.filter(F.split(bare, PARAGRAPH_END), lambda p: F.trim(p).contains("\n"))
    return F.concat(sentences, paragraphs, F.when(whole, F.array(bare)).otherwise(F.array().cast("array<string>")))


def spdx_licence(text: Column, names: dict[str, str]) -> Column:
    """What the first identifier line of a text names, if the templates know it."""
    said = F.regexp_extract_all(F.lower(F.regexp_extract(text, SPDX, 1)), F.lit(SPDX_ID), F.lit(0))
    known = F.transform(said, lambda w: F.regexp_replace(w, SPDX_TAIL, ""))
    table = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair])
    return F.get(F.filter(F.transform(known, lambda w: F.try_element_at(table, w)), lambda n: n.isNotNull()), F.lit(0))


def _words(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(WORD), F.lit(0))


def score_units(units: DataFrame, model: Model, threshold: float) -> DataFrame:
    """unit_id, n, licence, score of the distinct ``units`` (unit_id, n, unit)
    whose best cosine reaches the threshold."""
    spark = units.sparkSession
    weights = spark.createDataFrame(model.rows, "word string, template int, licence string, weight double")
    idf = spark.createDataFrame(list(model.idf.items()), "word string, idf double")
    tf = units.select("unit_id", F.explode(_words(F.col("unit"))).alias("word")).groupBy("unit_id", "word").agg(F.count("*").alias("tf"))
    vector = tf.join(F.broadcast(idf), "word", "left").select(
        "unit_id", "word", ((1 + F.log("tf")) * F.coalesce("idf", F.lit(model.other))).alias("x"))
    inside = weights.groupBy("word").agg(F.collect_list(F.struct("template", "weight")).alias("in"))  # one word's templates: a fixed list
    terms = vector.join(F.broadcast(inside), "word", "left")
    norm = terms.groupBy("unit_id").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = terms.select("unit_id", "x", F.explode("in").alias("t")).groupBy("unit_id", "t.template").agg(F.sum(F.col("x") * F.col("t.weight")).alias("dot"))
    cosine = F.round(F.col("dot") / F.col("norm"), 9)  # so that equal ones tie
    named = weights.select("template", "licence").distinct()
    best = dots.join(norm, "unit_id").select("unit_id", "template", cosine.alias("score")).where(F.col("score") >= threshold).join(
        F.broadcast(named), "template").groupBy("unit_id").agg(F.max(F.struct("score", "licence")).alias("best"))
    return units.select("unit_id", "n").join(best, "unit_id").select("unit_id", "n", "best.licence", "best.score")


def inherit(files: DataFrame, folder: str) -> DataFrame:
    """``files`` (folder, is_licence_file, own_licence, own_score and others)
    with licence, kind (own, inherited, none) and licence_folder. A folder that
    holds a large share of the files is not dealt to one task."""
    lent = files.where("is_licence_file and own_licence is not null").groupBy("folder").agg(
        F.max(F.struct("own_score", "own_licence")).alias("best")).select(F.col("folder").alias("above"), F.col("best.own_licence").alias("licence"))
    folders = files.groupBy("folder").agg(F.count("*").alias("n"))
    parts = F.split("folder", "/")
    ancestors = folders.select("folder", F.explode(F.when(F.col("folder") == "", F.array(F.lit(0))).otherwise(
        F.sequence(F.lit(0), F.size(parts)))).alias("depth")).select(
        "folder", "depth", F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("above"))
    near = ancestors.join(lent, "above").groupBy("folder").agg(F.max(F.struct("depth", "above", "licence")).alias("near"))
    near = folders.join(near, "folder", "left").select(
        "folder", "n", F.col("near.above").alias("licence_folder"), F.col("near.licence").alias("near_licence"))
    own = F.col("own_licence").isNotNull()
    return join_totals(files, near, ["folder"], files.count(), folder, "folders").select(
        *files.columns, F.coalesce("own_licence", "near_licence").alias("licence"),
        F.when(own, "own").when(F.col("near_licence").isNotNull(), "inherited").otherwise("none").alias("kind"),
        F.when(~own, F.col("licence_folder")).alias("licence_folder"))


def scan(files: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each row of ``files`` (doc_id, path, text): doc_id, path,
    own_licence, own_score, licence, kind, licence_folder."""
    model = Model(templates)
    folder = scratch(files.sparkSession, "licences")
    path = F.coalesce(F.col("path"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit(""))
    is_licence = F.regexp_extract(path, "([^/]*)$", 1).rlike(LICENCE_FILE)
    units = F.when(text.rlike(LICENCE_WORDS), F.filter(units_of(text, is_licence), lambda x: x.rlike(LICENCE_WORDS)))
    rows = materialise(files.select(
        F.col("doc_id").cast("long").alias("doc_id"), "path", F.regexp_replace(path, "/?[^/]*$", "").alias("folder"), is_licence.alias("is_licence_file"),
        F.monotonically_increasing_id().alias("row_id"), spdx_licence(text, model.names).alias("named"), F.array_distinct(units).alias("units")),
        "rows", folder)
    found = rows.select("row_id", F.explode("units").alias("unit")).select("row_id", F.md5("unit").alias("unit_id"), "unit")
    # one row for each distinct unit; copies of a frequent one are summed up first
    distinct = materialise(found.groupBy("unit_id").agg(F.first("unit").alias("unit"), F.count("*").alias("n")), "units", folder)
    scored = score_units(distinct, model, threshold)
    holders = distinct.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    own = join_totals(found.select("row_id", "unit_id"), scored, ["unit_id"], holders, folder, "scored", "inner").groupBy("row_id").agg(
        F.max(F.struct("score", "licence")).alias("best")).select("row_id", F.col("best.licence").alias("best_licence"), F.col("best.score").alias("best_score"))
    by_name = F.col("named").isNotNull()
    files_ = materialise(rows.drop("units").join(own, "row_id", "left").select(
        "doc_id", "path", "folder", "is_licence_file", F.coalesce("named", "best_licence").alias("own_licence"),
        F.when(by_name, F.lit(1.0)).otherwise(F.col("best_score")).alias("own_score")), "files", folder)
    return inherit(files_, folder).select("doc_id", "path", "own_licence", "own_score", "licence", "kind", "licence_folder")


def with_paths(docs: DataFrame) -> DataFrame:
    """``documents`` as files: doc_id, path, text. The folders are source,
    language and two levels of id ranges; a short text with a word like
    licence is a licence file, at a depth that its id decides."""
    text = F.coalesce(F.col("text"), F.lit(""))
    folders = F.array(F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")),
                      F.concat(F.lit("r"), F.coalesce(F.floor(F.col("doc_id") / 1024), F.lit(0))),
                      F.concat(F.lit("s"), F.coalesce(F.pmod(F.floor(F.col("doc_id") / 32), F.lit(32)), F.lit(0))))
    is_licence = (F.char_length(text) < 400) & F.lower(text).rlike("licen[cs]e")
    depth = F.when(is_licence, F.pmod(F.xxhash64("doc_id"), F.lit(4)).cast("int") + 1).otherwise(4)
    name = F.when(is_licence, F.lit("LICENSE")).otherwise(F.concat_ws("", F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select("doc_id", F.concat_ws("/", F.slice(folders, F.lit(1), depth), name).alias("path"), "text")
