"""What the statement history says of the workload: long-running statements by
thresholds from each group's own distribution, statements that match a table of
patterns, and statement shapes ranked by the time they used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.hints import fits_broadcast
from ..plans.skew import join_split
from ..session import ensure_checkpoint_dir

# --- durations ----------------------------------------------------------------

# Size of a quantile sketch: exact up to this many values, then a rank error of
# about 1.7 / k (0.8 % at 200).
SKETCH_SIZE = 200


def duration_us(start: str = "starttime", end: str = "endtime") -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end))


def owned_statements(statements: DataFrame, sessions: DataFrame) -> DataFrame:
    """Statements with the database and user of their session (null without
    one); a session that holds a large share of them is split."""
    return join_split(statements, sessions.select("sessionid", "username", "dbname"), ["sessionid"], "statementid")


def duration_sketches(owned: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """One row for each database, user and day of the end: the number of
    finished statements and a quantile sketch of their durations. Sketches are
    built in the scan's tasks and merged, and so can be those of many days: a
    night adds its day's rows to a stored table, no statement is read again."""
    done = owned.where(F.col("starttime").isNotNull() & F.col("endtime").isNotNull())
    return done.groupBy("dbname", "username", F.to_date("endtime").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint(duration_us(), F.lit(size)).alias("sketch"))


def duration_thresholds(sketches: DataFrame, by: list[str], quantile: float) -> DataFrame:
    """``by`` columns, n, threshold_us: the duration that a share ``quantile``
    of the group's statements does not exceed (the value at place ceil(quantile
    * n) in order), from merged sketches."""
    merged = sketches.groupBy(*by).agg(F.sum("n").alias("n"), F.kll_merge_agg_bigint("sketch").alias("_s"))
    return merged.select(*by, "n", F.kll_sketch_get_quantile_bigint("_s", F.lit(quantile)).alias("threshold_us"))


def unusually_long(owned: DataFrame, thresholds: DataFrame, by: list[str], min_statements: int = 1) -> DataFrame:
    """Finished statements above the threshold of their group, groups of at
    least ``min_statements``. Groups with a null name take part (null is a
    group like any other)."""
    names = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")).alias(f"_g_{c}") for c in by]
    keys = [f"_g_{c}" for c in by]
    limits = thresholds.where(F.col("n") >= min_statements).select(*names, "n", "threshold_us")
    rows = owned.where(F.col("starttime").isNotNull() & F.col("endtime").isNotNull()).select(
        "statementid", "sessionid", "dbname", "username", duration_us().alias("duration_us"), *names)
    met = join_split(rows, limits, keys, "statementid", how="inner")
    return met.where(F.col("duration_us") > F.col("threshold_us")).select(
        "statementid", "sessionid", "dbname", "username", "duration_us", "threshold_us", F.col("n").alias("group_statements"))


# --- patterns -----------------------------------------------------------------

GRAM = 3
# A word or gram that no more patterns than this have tells them apart.
FEW = 8
WORD = r"[\p{L}\p{N}]"


def _pieces(pattern: Column) -> Column:
    """The literal runs of a LIKE pattern (``%`` and ``_`` are the wildcards; a
    wildcard after ``\\`` is itself, and ends a run here)."""
    return F.filter(F.split(pattern, r"\\.|[%_]"), lambda p: F.length(p) > 0)


def _grams(text: Column, size: int) -> Column:
    """All substrings of ``size`` characters, in one pass over the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def _sized_grams(runs: Column, size: int) -> Column:
    """(size, anchor) for the distinct grams of a list of runs."""
    grams = F.array_distinct(F.flatten(F.transform(runs, lambda r: _grams(r, size))))
    return F.transform(grams, lambda g: F.struct(F.lit(size).alias("size"), g.alias("anchor")))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"{WORD}++"), F.lit(0))


def _whole_words(pattern: Column) -> Column:
    """The words of a LIKE pattern that are words of every text that matches:
    no wildcard (or escaped character) stands beside them."""
    beside = rf"[\p{{L}}\p{{N}}%_\\]"
    return F.regexp_extract_all(pattern, F.lit(f"(?<!{beside}){WORD}++(?!{beside})"), F.lit(0))


def _rarest(choices: DataFrame) -> DataFrame:
    """(pattern_id, pattern, size, anchor, n): of a pattern's choices (size,
    anchor) the first size of which one is had by FEW patterns or less, else the
    one that fewest have."""
    counts = choices.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.when(F.col("n") <= FEW, 0).otherwise(F.col("n")).alias("level"), "size", "n", (-F.length("anchor")).alias("l"), "anchor")
    best = choices.join(counts, "anchor").groupBy("pattern_id", "pattern").agg(F.min(order).alias("_a"))
    return best.select("pattern_id", "pattern", "_a.size", "_a.anchor", "_a.n")


def pattern_anchors(patterns: DataFrame, gram: int = GRAM) -> DataFrame:
    """(pattern_id, pattern, size, anchor): lower-case LIKE patterns with what a
    text must hold to match: a whole word (size 0) or a gram of ``size``
    characters. Of a pattern's words it is the one that fewest patterns have:
    what a family of patterns has in common does not tell them apart. Patterns
    without a word of their own have the shortest gram, of ``gram`` characters,
    twice or four times as many, that few patterns have. Without a literal run
    of ``gram`` characters it is the longest run itself. A pattern without
    literals fails: it would match everything."""
    ensure_checkpoint_dir(patterns.sparkSession)
    low = patterns.where(F.col("pattern").isNotNull()).select("pattern_id", F.lower("pattern").alias("pattern")).distinct()
    word = F.explode(F.array_distinct(_whole_words(F.col("pattern")))).alias("anchor")
    named = _rarest(low.select("pattern_id", "pattern", F.lit(0).alias("size"), word)).checkpoint()
    told = named.where(F.col("n") <= FEW)
    same = [F.col("pattern_id").eqNullSafe(F.col("_id")), F.col("pattern") == F.col("_pattern")]
    runs = low.join(told.select(F.col("pattern_id").alias("_id"), F.col("pattern").alias("_pattern")), same, "left_anti").withColumn(
        "_runs", _pieces(F.col("pattern")))
    every = F.concat(*[_sized_grams(F.col("_runs"), size) for size in (gram, 2 * gram, 4 * gram)])
    longest = F.get(F.sort_array(F.transform("_runs", lambda r: F.struct(F.length(r).alias("l"), r.alias("r"))), asc=False), F.lit(0))
    failed = F.raise_error(F.concat(F.lit("a pattern needs a literal character: "), F.col("pattern"))).cast("struct<size:int,anchor:string>")
    choices = runs.select("pattern_id", "pattern", F.explode(F.when(F.size(every) > 0, every).otherwise(F.array(F.when(longest.isNull(), failed).otherwise(
        F.struct(longest.getField("l").alias("size"), longest.getField("r").alias("anchor")))))).alias("c")).select("pattern_id", "pattern", "c.size", "c.anchor")
    choices = choices.unionByName(named.where(F.col("n") > FEW).drop("n"))
    return told.unionByName(_rarest(choices)).select("pattern_id", "pattern", "size", "anchor").checkpoint()


def match_patterns(rows: DataFrame, text_col: str, id_col: str, patterns: DataFrame, gram: int = GRAM, *,
                   max_broadcast_bytes: int | None = None) -> DataFrame:
    """(``id_col``, pattern_id) for each pattern (LIKE, any case) that a row's
    text matches. ``patterns``: pattern_id, pattern; thousands of them cost one
    scan of the texts.

    Every pattern has one anchor, so a text and a pattern meet at most once: the
    distinct words and grams of a text are joined with the anchors and what
    meets is verified by the pattern itself. The patterns are broadcast if
    their measured size allows it; else texts are dealt by what they share with
    the anchors (of which a hash goes to every task, if these allow it), and
    what many texts have in pieces."""
    options = {} if max_broadcast_bytes is None else {"max_broadcast_bytes": max_broadcast_bytes}
    anchors = pattern_anchors(patterns, gram)
    sizes = sorted(r[0] for r in anchors.select("size").distinct().collect())  # the words, and at most ``gram`` + 2 more
    low = rows.where(F.col(text_col).isNotNull()).select(id_col, F.lower(text_col).alias("_text"))
    if not sizes:
        return low.select(id_col, F.lit(None).cast(patterns.schema["pattern_id"].dataType).alias("pattern_id")).limit(0)
    held = F.array_distinct(F.flatten(F.array(*[_grams(F.col("_text"), s) if s else _words(F.col("_text")) for s in sizes])))
    found = low.select(id_col, "_text", F.explode(held).alias("anchor"))
    hashes = anchors.select(F.xxhash64("anchor").alias("_hash")).distinct()
    if not fits_broadcast(anchors, **({} if max_broadcast_bytes is None else {"max_bytes": max_broadcast_bytes})) and fits_broadcast(hashes):
        found = found.join(F.broadcast(hashes), F.xxhash64("anchor") == F.col("_hash"), "left_semi")
    met = join_split(found, anchors.drop("size"), ["anchor"], id_col, how="inner", **options)
    return met.where(F.like("_text", "pattern")).select(id_col, "pattern_id")


# --- shapes ---------------------------------------------------------------------

# The kinds of token of a statement, in the order they are tried: strings,
# comments, quoted names, numbers, words, any other character.
TOKENS = r"""'[^']*'?|--[^\n]*|/\*[\s\S]*?(?:\*/|\z)|"[^"]*"?|[0-9]+(?:[.][0-9]+)?(?:[eE][-+]?[0-9]+)?|[A-Za-z_][A-Za-z0-9_$]*|[^ \t\n\r\f\x0B]"""
BLANK = "?"


def statement_shape(text: Column) -> Column:
    """A statement without what changes from one call to the next: comments
    go, strings and numbers become ``?``, words are in lower case, tokens have
    one space between them, and a list of ``?`` is one ``?``. Each token is
    taken by one pass of the pattern, so a quote in a comment or a comment sign
    in a string is read for what it is; quoted names stay as they are."""
    tokens = F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0))
    first = "^[0-9']"
    plain = F.transform(F.filter(tokens, lambda t: ~t.startswith("--") & ~t.startswith("/*")),
                        lambda t: F.when(t.rlike(first), F.lit(BLANK)).when(t.startswith('"'), t).otherwise(F.lower(t)))
    joined = F.array_join(plain, " ")
    return F.regexp_replace(F.regexp_replace(joined, r"\?(?: \?)+", BLANK), r"\?(?: , \?)+", BLANK)


def shape_report(owned: DataFrame, top: int) -> DataFrame:
    """The ``top`` shapes of each database and of all of them, by the time
    their finished statements used: dbname, all_databases, shape, calls, users,
    total_us, longest_us, place.

    Durations are summed by (database, user, shape) in the scan's tasks; what
    is above is made from those sums. Places are taken within limited groups:
    Spark keeps the first ``top`` of each task before it shuffles them."""
    done = owned.where(F.col("starttime").isNotNull() & F.col("endtime").isNotNull() & F.col("statement").isNotNull())
    fine = done.select("dbname", "username", statement_shape(F.col("statement")).alias("shape"), duration_us().alias("_d")).groupBy(
        "dbname", "username", "shape").agg(F.count(F.lit(1)).alias("calls"), F.sum("_d").alias("total_us"), F.max("_d").alias("longest_us"))
    by_database = fine.groupBy("dbname", "shape").agg(
        F.sum("calls").alias("calls"), F.count("username").alias("users"), F.sum("total_us").alias("total_us"), F.max("longest_us").alias("longest_us"))
    users = fine.where(F.col("username").isNotNull()).select("username", "shape").distinct().groupBy("shape").agg(F.count(F.lit(1)).alias("users"))
    overall = by_database.groupBy("shape").agg(
        F.sum("calls").alias("calls"), F.sum("total_us").alias("total_us"), F.max("longest_us").alias("longest_us")).join(users, "shape", "left")
    columns = ["shape", "calls", F.coalesce("users", F.lit(0)).alias("users"), "total_us", "longest_us"]
    rows = by_database.select("dbname", F.lit(False).alias("all_databases"), *columns).unionByName(
        overall.select(F.lit(None).cast("string").alias("dbname"), F.lit(True).alias("all_databases"), *columns))
    order = Window.partitionBy("all_databases", "dbname").orderBy(F.desc("total_us"), "shape")
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
