"""Union of time intervals, and what follows from it: ends of sessions that
were never closed, and stretches in which a user did nothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ts_literal
from ..plans.skew import join_split

# Buckets of a gap's width that are ordered in one piece.
BUCKETS_PER_PIECE = 4096
# Piece width where intervals join only if they touch (no gap to bucket by).
TOUCHING_PIECE_SECONDS = 86_400


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", ts_literal("1970-01-01 00:00:00"), ts)


def _plus(ts: Column, seconds: int) -> Column:
    return F.timestamp_add("SECOND", F.lit(seconds), ts)


def merged_intervals(df: DataFrame, by: list[str], start: str, end: str, gap_seconds: int = 0) -> DataFrame:
    """The union of the intervals of each ``by`` group: ``by`` columns,
    merged_from, merged_to, n (intervals in it). Intervals join if the later
    one starts at most ``gap_seconds`` after everything before it has ended.
    Rows without a start or a ``by`` value are left out; an end that is null or
    before the start counts as the start.

    A group is never ordered in one task. Starts in one bucket of the gap's
    width are less than a gap apart and join anyway, so rows first collapse to
    one a bucket by partial aggregation: a service account costs no more than
    anybody. Buckets are ordered within pieces of ``BUCKETS_PER_PIECE``; a
    running maximum of the ends gives the islands of a piece. A summary row a
    piece carries on the latest end before it, and where the island began that
    reaches into it, so that islands join over pieces."""
    rows = df.where(F.col(start).isNotNull())
    for c in by:
        rows = rows.where(F.col(c).isNotNull())
    rows = rows.select(*by, F.col(start).alias("_s"), F.greatest(F.coalesce(end, start), start).alias("_e"))
    if gap_seconds:
        bucket = F.floor(_micros(F.col("_s")) / F.lit(gap_seconds * 1_000_000))
        rows = rows.groupBy(*by, bucket.alias("_b")).agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.count(F.lit(1)).alias("_n"))
        rows = rows.withColumn("_p", F.floor(F.col("_b") / BUCKETS_PER_PIECE)).drop("_b")
    else:
        rows = rows.withColumn("_n", F.lit(1).cast("long")).withColumn(
            "_p", F.floor(_micros(F.col("_s")) / F.lit(TOUCHING_PIECE_SECONDS * 1_000_000)))
    inside = Window.partitionBy(*by, "_p").orderBy("_s", "_e")
    before = F.max("_e").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    opens = before.isNull() | (F.col("_s") > _plus(before, gap_seconds))
    islands = (rows.withColumn("_new", opens.cast("int"))
               .withColumn("_i", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
               .groupBy(*by, "_p", "_i").agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum("_n").alias("_n")))
    # over the pieces: a row for each
    pieces = Window.partitionBy(*by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ends = islands.groupBy(*by, "_p").agg(F.max("_e").alias("_last")).withColumn("_carry", F.max("_last").over(pieces)).drop("_last")
    fresh = F.when(F.col("_carry").isNull() | (F.col("_s") > _plus(F.col("_carry"), gap_seconds)), F.col("_s"))
    marked = islands.join(ends, [*by, "_p"]).withColumn("_fresh", fresh)
    begun = marked.groupBy(*by, "_p").agg(F.max("_fresh").alias("_f")).withColumn("_begun", F.max("_f").over(pieces)).drop("_f")
    up_to = Window.partitionBy(*by, "_p").orderBy("_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = marked.join(begun, [*by, "_p"]).withColumn("_id", F.coalesce(F.max("_fresh").over(up_to), "_begun"))
    return named.groupBy(*by, "_id").agg(F.min("_s").alias("merged_from"), F.max("_e").alias("merged_to"), F.sum("_n").alias("n")).drop("_id")


def closed_sessions(sessions: DataFrame, statements: DataFrame, as_of, gap_seconds: int) -> DataFrame:
    """Sessions with an end for those that have none recorded.

    The statements of an open session are cut into bursts: a new one begins
    where nothing ran for more than ``gap_seconds``. A session whose last burst
    ended more than that before ``as_of`` counts as ended with it (without
    statements: with its start); the others are still open. Columns:
    sessionid, username, dbname, starttime, endtime (as recorded),
    effective_end, end_source ('recorded', 'derived', 'open'), bursts,
    busy_us (length of the bursts). A statement still running at ``as_of``
    keeps its session open. Sessions without a start stay open."""
    now = ts_literal(as_of)
    columns = ["sessionid", "username", "dbname", "starttime", "endtime"]
    open_ = sessions.where(F.col("endtime").isNull()).select("sessionid")
    work = statements.where(F.col("starttime") < now).select("sessionid", "statementid", "starttime", F.least(F.coalesce("endtime", now), now).alias("_end"))
    work = join_split(work, open_.distinct().withColumn("_open", F.lit(True)), ["sessionid"], "statementid", how="inner")
    bursts = merged_intervals(work, ["sessionid"], "starttime", "_end", gap_seconds)
    per = bursts.groupBy("sessionid").agg(
        F.max("merged_to").alias("_last"), F.count(F.lit(1)).alias("bursts"),
        F.sum(F.timestamp_diff("MICROSECOND", F.col("merged_from"), F.col("merged_to"))).alias("busy_us"))
    last = F.coalesce("_last", "starttime")
    ended = F.when(_plus(last, gap_seconds) < now, last)
    met = sessions.select(*columns).join(per, "sessionid", "left")
    source = F.when(F.col("endtime").isNotNull(), "recorded").when(ended.isNotNull(), "derived").otherwise("open")
    return met.select(*columns, F.coalesce("endtime", ended).alias("effective_end"), source.alias("end_source"),
                      F.coalesce("bursts", F.lit(0)).alias("bursts"), F.coalesce("busy_us", F.lit(0)).alias("busy_us"))


def user_activity(sessions: DataFrame, as_of, gap_seconds: int = 0) -> DataFrame:
    """Merged activity of each user: username, merged_from, merged_to, n
    (sessions). An open session counts up to ``as_of``."""
    now = ts_literal(as_of)
    rows = sessions.where(F.col("starttime") <= now).select("username", "starttime", F.coalesce("endtime", now).alias("_end"))
    return merged_intervals(rows, ["username"], "starttime", "_end", gap_seconds)


def inactive_stretches(sessions: DataFrame, users: DataFrame, as_of, min_seconds: int) -> DataFrame:
    """Every stretch of at least ``min_seconds`` in which a user of the history
    did nothing: username, userid, idle_from, idle_to, idle_us, kind ('before'
    the first activity, 'between' two, 'after' the last one up to ``as_of`` or
    the deletion, 'never' active). Exempt users are left out.

    Intervals that are nearer than ``min_seconds`` are merged with that gap, so
    only those that bound a stretch come out, and a user's are few: at most one
    for each ``min_seconds`` of time."""
    now = ts_literal(as_of)
    known = users.where(F.col("username").isNotNull() & ~F.coalesce("exempt_activity_flag", F.lit(False))).select(
        "username", "userid", F.col("first_captured_time").alias("_since"), F.least(F.coalesce("delete_time", now), now).alias("_until"))
    # stretches of exactly min_seconds count: times are whole microseconds
    active = user_activity(sessions, as_of, min_seconds - 1 if min_seconds > 1 else 0)
    order = Window.partitionBy("username").orderBy("merged_from")
    spans = active.withColumn("_next", F.lead("merged_from").over(order)).withColumn("_first", F.row_number().over(order) == 1)
    met = known.join(spans, "username", "left")
    stretches = F.array(
        F.struct(F.when(F.col("merged_from").isNull(), F.col("_since")).alias("f"), F.col("_until").alias("t"), F.lit("never").alias("k")),
        F.struct(F.when(F.col("_first"), F.col("_since")).alias("f"), F.least("merged_from", "_until").alias("t"), F.lit("before").alias("k")),
        F.struct(F.greatest("merged_to", "_since").alias("f"), F.least(F.coalesce("_next", "_until"), "_until").alias("t"),
                 F.when(F.col("_next").isNull(), "after").otherwise("between").alias("k")))
    long_ = met.select("username", "userid", "merged_from", F.explode(stretches).alias("x")).where(
        (F.col("merged_from").isNotNull() | (F.col("x.k") == "never")) & F.col("x.f").isNotNull())
    idle = F.timestamp_diff("MICROSECOND", F.col("x.f"), F.col("x.t"))
    return long_.where(idle >= F.lit(min_seconds * 1_000_000)).select(
        "username", "userid", F.col("x.f").alias("idle_from"), F.col("x.t").alias("idle_to"), idle.alias("idle_us"), F.col("x.k").alias("kind"))
