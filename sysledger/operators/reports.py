"""Uses of the captured history that the job documents name: statement
attribution, long-running statements, inactive users, capture gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ts_literal
from ..plans.hints import broadcast_if_small


def statement_attribution(statements: DataFrame, sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Each statement with the session's user and that user's history row
    (dropped users included, flagged by ``user_deleted``).

    Statements x sessions is a shuffled join on ``sessionid`` (both sides
    grow with activity); AQE splits a session holding a large share of the
    statements (skew join). The users side is keyed by username, reduced
    to one row per username and broadcast after a size check."""
    sess = sessions.select("sessionid", "username", "dbname")
    user_side = users.groupBy("username").agg(
        F.max("userid").alias("userid"),
        F.max(F.col("delete_time").isNotNull()).alias("user_deleted"),
    )
    # statements without a user (no session, or a session that is not known)
    # go round the second join: their common null would be one partition
    found = statements.select("statementid", "sessionid", "starttime", "endtime").join(sess, "sessionid", "left")
    named = found.where(F.col("username").isNotNull()).join(broadcast_if_small(user_side), "username", "left")
    nameless = found.where(F.col("username").isNull()).select(
        "*", F.lit(None).cast("int").alias("userid"), F.lit(None).cast("boolean").alias("user_deleted"))
    out = named.unionByName(nameless)
    return out.select("statementid", "sessionid", "username", "dbname", "userid", "user_deleted", "starttime", "endtime")


def statements_matching(statements: DataFrame, sessions: DataFrame, users: DataFrame, patterns: list[str]) -> DataFrame:
    """Statements whose text holds one of the ``patterns`` (regular
    expressions, any case), with their user as in ``statement_attribution``.
    Only the statements that match are joined."""
    text = F.lower(F.col("statement"))
    hit = F.lit(False)
    for p in patterns:
        hit = hit | text.rlike(p.lower())
    return statement_attribution(statements.where(hit), sessions, users)


def long_running(statements: DataFrame, min_seconds: int) -> DataFrame:
    """Finished statements that ran at least ``min_seconds``."""
    dur = F.timestamp_diff("MICROSECOND", F.col("starttime"), F.col("endtime"))
    return (
        statements.where(F.col("endtime").isNotNull() & (dur >= F.lit(min_seconds * 1_000_000)))
        .select("statementid", "sessionid", "starttime", "endtime", dur.alias("duration_us"))
    )


def inactive_users(history: DataFrame, as_of, days: int) -> DataFrame:
    """Live, non-exempt, non-revoked users with no activity in the last
    ``days`` days before ``as_of``."""
    cutoff = F.timestamp_add("DAY", F.lit(-days), ts_literal(as_of))
    keep = (
        F.col("delete_time").isNull()
        & F.col("connect_revoked_time").isNull()
        & ~F.coalesce(F.col("exempt_activity_flag"), F.lit(False))
        & (F.coalesce(F.col("last_activity_time"), F.col("first_captured_time")) < cutoff)
    )
    return history.where(keep).select("userid", "username", "last_activity_time", "first_captured_time")


_EPOCH = "1970-01-01 00:00:00"


def capture_gaps(df: DataFrame, ts_col: str, max_gap_seconds: int, by: list[str] | None = None) -> DataFrame:
    """Consecutive times (in ``ts_col`` order, within each ``by`` group) more
    than ``max_gap_seconds`` apart: the periods in which nothing was captured.

    Times are cut into buckets of the gap width. Two times in one bucket are
    less than a width apart, so every gap lies between the last time of a
    non-empty bucket and the first time of the next non-empty one. The rows
    reduce to one (min, max) per bucket by partial aggregation (a dense
    bucket or group costs nothing extra); only those summaries are ordered,
    within coarse groups of 4096 buckets, and the boundary between two coarse
    groups comes from one summary row per coarse group."""
    by = list(by or [])
    width = max_gap_seconds * 1_000_000
    ts = F.col(ts_col)
    bucket = F.floor(F.timestamp_diff("MICROSECOND", ts_literal(_EPOCH), ts) / F.lit(width))
    summary = (
        df.where(ts.isNotNull())
        .groupBy(*by, bucket.alias("_b"))
        .agg(F.min(ts).alias("_first"), F.max(ts).alias("_last"))
        .withColumn("_c", F.floor(F.col("_b") / F.lit(4096)))
    )
    w = Window.partitionBy(*by, "_c").orderBy("_b")
    within = summary.select(*by, "_c", "_b", F.lag("_last").over(w).alias("gap_start"), F.col("_first").alias("gap_end"))
    # first bucket of each coarse group: its predecessor is the last time of
    # the previous non-empty coarse group (one row per coarse group)
    groups = summary.groupBy(*by, "_c").agg(F.min("_b").alias("_min_b"), F.max("_last").alias("_max_last"))
    wg = Window.partitionBy(*by).orderBy("_c")
    prev = groups.select(*by, "_c", "_min_b", F.lag("_max_last").over(wg).alias("_prev_last"))
    joined = within.join(prev, [*by, "_c"], "inner").select(
        *by,
        F.when(F.col("_b") == F.col("_min_b"), F.col("_prev_last")).otherwise(F.col("gap_start")).alias("gap_start"),
        "gap_end",
    )
    gap = F.timestamp_diff("MICROSECOND", F.col("gap_start"), F.col("gap_end"))
    return joined.where(F.col("gap_start").isNotNull() & (gap > F.lit(width))).select(
        *by, "gap_start", "gap_end", gap.alias("gap_us"))


# Runs of a capture job must be less than this apart, or rows purged from
# the source in between are lost (fixed value of the jobs: 72 hours).
MAX_RUN_SPACING_HOURS = 72


def run_gaps(run_log: DataFrame, max_hours: int = MAX_RUN_SPACING_HOURS) -> DataFrame:
    """Pairs of consecutive runs of the same job ``max_hours`` apart or more,
    from a store's run log: runs must be less than that apart."""
    # times are whole microseconds, so "at least" is "more than" one less
    wide = capture_gaps(run_log, "run_ts", max_hours * 3600 - 1, by=["job"])
    return wide.where(F.col("gap_us") >= F.lit(max_hours * 3_600_000_000))
