"""User history: a slowly changing dimension kept from the current user
list and the sessions captured by the same run.

Steps (each an UPDATE/INSERT of the nightly job, applied in order):
  1. refresh changed users, resurrecting deleted ones  (match: username)
  2. insert users seen for the first time              (match: username)
  3. last activity from this run's sessions            (match: username)
  4. soft-delete users missing from the source         (match: userid)
  5. clear the revocation of users with a later session (match: userid)

Each step is a function ``history -> history``; ``sync_users`` fuses all
five into one plan with identical results and reports the five counts.

Scale: sessions are reduced to one row per username (partial aggregation,
so a service account with a third of all sessions costs one row per input
partition) before they meet the users. User sides are broadcast after a
size check; the history itself is scanned, never shuffled, on that path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import any_true, differs, ts_literal
from .capture import append_rows
from ..plans.hints import broadcast_if_small, fits_broadcast, fits_broadcast_all, max_broadcast_rows
from ..schemas import (USER_BOOKKEEPING, USER_COMPARED_COLUMNS, USER_DBA_COLUMNS, USER_SOURCE_COLUMNS,
                       USERS_HISTORY, typed_null)

HIST_COLUMNS = [f.name for f in USERS_HISTORY.fields]


def _n(c: str) -> str:
    return f"_n_{c}"


def _renamed_source(users_new: DataFrame) -> DataFrame:
    return users_new.select(*[F.col(c).alias(_n(c)) for c in USER_SOURCE_COLUMNS])


def _changed() -> Column:
    """Row-level change test of step 1 on a history row joined to its
    source row: any compared column differs (``!=``, so a change from or
    to null alone does not count) or the user had been deleted."""
    diffs = [differs(F.col(c), F.col(_n(c))) for c in USER_COMPARED_COLUMNS]
    return F.col(_n("username")).isNotNull() & any_true(diffs + [F.col("delete_time").isNotNull()])


def _refreshed_columns(changed: Column) -> list[Column]:
    """History columns after step 1 on rows left-joined to the source."""
    def pick(c: str) -> Column:
        if c in USER_COMPARED_COLUMNS:
            return F.when(changed, F.col(_n(c))).otherwise(F.col(c)).alias(c)
        if c == "delete_time":
            return F.when(changed, typed_null("timestamp_ntz")).otherwise(F.col(c)).alias(c)
        return F.col(c)
    return [pick(c) for c in HIST_COLUMNS]


def _new_rows(users_new: DataFrame, run_ts) -> DataFrame:
    """Step 2's inserted row for each source user: captured and active
    now, not exempt, DBA columns empty."""
    now = ts_literal(run_ts)
    extra = {
        "first_captured_time": now,
        "last_activity_time": now,
        "exempt_activity_flag": F.lit(False),
    }
    cols = [F.col(c) for c in USER_SOURCE_COLUMNS]
    cols += [(extra[f.name] if f.name in extra else typed_null(f.dataType)).alias(f.name) for f in USER_BOOKKEEPING.fields]
    return users_new.select(*cols)


def _known_names(history: DataFrame, users_new: DataFrame, side=broadcast_if_small) -> DataFrame:
    """Source usernames present in the history; bounded by the source size.
    Only the history's username column is read."""
    names = users_new.select("username").where(F.col("username").isNotNull())
    return history.select("username").join(side(names), "username", "left_semi").distinct()


def session_activity(sessions_new: DataFrame, run_ts=None) -> DataFrame:
    """Per username: latest session start (``_ls``) and, given the run
    time, last activity (``_la``: latest end, an open session counting as
    now)."""
    aggs = [F.max("starttime").alias("_ls")]
    if run_ts is not None:
        aggs.insert(0, F.max(F.coalesce(F.col("endtime"), ts_literal(run_ts))).alias("_la"))
    return sessions_new.where(F.col("username").isNotNull()).groupBy("username").agg(*aggs)


# --- the five steps, one at a time ---------------------------------------

def users_update_changed(history: DataFrame, users_new: DataFrame) -> DataFrame:
    """Step 1: refresh source columns of changed users, clear delete_time."""
    joined = history.join(broadcast_if_small(_renamed_source(users_new)),
                          F.col("username") == F.col(_n("username")), "left")
    return joined.select(*_refreshed_columns(_changed()))


def users_insert_new(history: DataFrame, users_new: DataFrame, run_ts) -> DataFrame:
    """Step 2: append users whose username the history does not hold."""
    users_fit = fits_broadcast(users_new)

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if users_fit else df

    fresh = users_new.join(side(_known_names(history, users_new, side)), "username", "left_anti")
    return append_rows(history.select(*HIST_COLUMNS), _new_rows(fresh, run_ts))


def users_last_activity(history: DataFrame, sessions_new: DataFrame, run_ts) -> DataFrame:
    """Step 3: last_activity_time := latest end of the user's staged
    sessions. Overwritten, not maximised: it can move backwards."""
    acts = broadcast_if_small(session_activity(sessions_new, run_ts).select("username", "_la"))
    out = history.join(acts, "username", "left")
    return out.select(*[F.coalesce(F.col("_la"), F.col(c)).alias(c) if c == "last_activity_time" else F.col(c)
                        for c in HIST_COLUMNS])


def _source_ids(users_new: DataFrame) -> DataFrame:
    return users_new.select(F.col("userid").alias("_sid")).where(F.col("_sid").isNotNull()).distinct()


def users_soft_delete(history: DataFrame, users_new: DataFrame, run_ts) -> DataFrame:
    """Step 4: delete_time := now for live users whose userid is no longer
    in the source (a null userid never matches, so it is left alone)."""
    ids = broadcast_if_small(_source_ids(users_new))
    out = history.join(ids, F.col("userid") == F.col("_sid"), "left")
    gone = F.col("userid").isNotNull() & F.col("_sid").isNull() & F.col("delete_time").isNull()
    return out.select(*[F.when(gone, ts_literal(run_ts)).otherwise(F.col(c)).alias(c) if c == "delete_time" else F.col(c)
                        for c in HIST_COLUMNS])


def _cleared_ids(history: DataFrame, acts: DataFrame) -> DataFrame:
    """Userids having a row revoked before one of its username's staged
    session starts (``revoked < max(start)``, the theta join reduced)."""
    hit = history.join(acts, "username", "inner").where(F.col("connect_revoked_time") < F.col("_ls"))
    return hit.select(F.col("userid").alias("_cid")).where(F.col("_cid").isNotNull()).distinct()


def users_clear_revoked(history: DataFrame, sessions_new: DataFrame, run_ts=None) -> DataFrame:
    """Step 5: connect_revoked_time := null on every row of a userid that
    has a session starting after its revocation (``run_ts`` is unused: the
    rule reads session starts only)."""
    acts = broadcast_if_small(session_activity(sessions_new))
    ids = broadcast_if_small(_cleared_ids(history, acts))
    out = history.join(ids, F.col("userid") == F.col("_cid"), "left")
    return out.select(*[F.when(F.col("_cid").isNotNull(), typed_null("timestamp_ntz")).otherwise(F.col(c)).alias(c)
                        if c == "connect_revoked_time" else F.col(c) for c in HIST_COLUMNS])


def set_user_attributes(history: DataFrame, edits: DataFrame) -> DataFrame:
    """Manual DBA edit by username: columns present in ``edits`` (any of
    the DBA columns) replace the history's values on matching rows;
    a null in an edit sets null."""
    cols = [c for c in edits.columns if c in USER_DBA_COLUMNS]
    side = edits.select(F.col("username").alias("_e_username"), *[F.col(c).alias(f"_e_{c}") for c in cols])
    out = history.join(broadcast_if_small(side), F.col("username") == F.col("_e_username"), "left")
    hit = F.col("_e_username").isNotNull()
    return out.select(*[F.when(hit, F.col(f"_e_{c}")).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                        for c in HIST_COLUMNS])


# --- fused sync -----------------------------------------------------------

def sync_users_flagged(history: DataFrame, users_new: DataFrame, sessions_new: DataFrame, run_ts, *,
                       users_rows: int | None = None, sessions_rows: int | None = None) -> DataFrame:
    """All five steps in one plan. Returns the new history plus one flag
    column per step (``_upd``, ``_ins``, ``_act``, ``_del``, ``_clr``)
    telling whether that step's statement touched the row.

    Two sizes are checked: the source user list and the per-username
    session activity. Every other user-side set (matched names, source
    ids) is a subset of the source list and inherits its bound; the set of
    userids whose revocation is cleared gets its own check."""
    now = ts_literal(run_ts)
    activity = session_activity(sessions_new, run_ts)
    # a caller that already counted the staged users / sessions (the jobs,
    # while staging them) passes the counts: the activity has at most one
    # row per staged session. Sides without a count are counted here, in
    # one job.
    users_fit = None if users_rows is None else users_rows <= max_broadcast_rows(users_new)
    acts_fit = None if sessions_rows is None else sessions_rows <= max_broadcast_rows(activity)
    unknown = [df for df, fit in ((users_new, users_fit), (activity, acts_fit)) if fit is None]
    counted = iter(fits_broadcast_all(*unknown)) if unknown else iter(())
    users_fit = next(counted) if users_fit is None else users_fit
    acts_fit = next(counted) if acts_fit is None else acts_fit

    def user_side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if users_fit else df

    # steps 1-2: refresh matched rows, append the new ones
    joined = (history.join(user_side(_renamed_source(users_new)), F.col("username") == F.col(_n("username")), "left")
              .withColumn("_upd", _changed()))
    base_old = joined.select(*_refreshed_columns(F.col("_upd")), F.col("_upd"), F.lit(False).alias("_ins"))
    fresh = users_new.join(user_side(_known_names(history, users_new, user_side)), "username", "left_anti")
    base_new = _new_rows(fresh, run_ts).select(*HIST_COLUMNS, F.lit(False).alias("_upd"), F.lit(True).alias("_ins"))
    base = base_old.unionByName(base_new)

    # steps 3-5 read the staged sessions reduced per username, and the source ids
    acts = F.broadcast(activity) if acts_fit else activity
    out = (
        base.join(acts, "username", "left")
        .join(user_side(_source_ids(users_new)), F.col("userid") == F.col("_sid"), "left")
    )
    # step 5 clears every row of a userid that has one row revoked before a
    # later session: the userids are reduced to a distinct set (partial
    # aggregation, so a userid shared by many rows stays cheap) and joined
    # back map-side after a size check
    # new rows are never revoked, so the set comes from the refreshed history
    # alone, by three narrow columns; Spark sees its size when it has run
    narrow = base_old.where(F.col("connect_revoked_time").isNotNull() & F.col("userid").isNotNull()).select(
        "userid", "username", "connect_revoked_time").join(acts.select("username", "_ls"), "username")
    cleared = narrow.where(F.col("connect_revoked_time") < F.col("_ls")).select(F.col("userid").alias("_cid")).distinct()
    out = out.join(cleared, F.col("userid") == F.col("_cid"), "left")
    act = F.col("_la").isNotNull()
    gone = F.col("userid").isNotNull() & F.col("_sid").isNull() & F.col("delete_time").isNull()
    clr = F.col("_cid").isNotNull()
    final = {
        "last_activity_time": F.when(F.col("_act"), F.col("_la")).otherwise(F.col("last_activity_time")),
        "delete_time": F.when(F.col("_del"), now).otherwise(F.col("delete_time")),
        "connect_revoked_time": F.when(F.col("_clr"), typed_null("timestamp_ntz")).otherwise(F.col("connect_revoked_time")),
    }
    flagged = out.select(*HIST_COLUMNS, "_la", "_upd", "_ins", act.alias("_act"), gone.alias("_del"), clr.alias("_clr"))
    return flagged.select(*[(final[c] if c in final else F.col(c)).alias(c) for c in HIST_COLUMNS],
                          "_upd", "_ins", "_act", "_del", "_clr")


def sync_users(history: DataFrame, users_new: DataFrame, sessions_new: DataFrame, run_ts) -> DataFrame:
    """New users history after the nightly sync (steps 1-5 in order)."""
    return sync_users_flagged(history, users_new, sessions_new, run_ts).select(*HIST_COLUMNS)


def sync_user_counts(flagged: DataFrame) -> DataFrame:
    """One row of per-step row counts, as the UPDATE/INSERT tags report
    them, from the output of ``sync_users_flagged``."""
    def n(flag: str, alias: str) -> Column:
        return F.coalesce(F.sum(F.col(flag).cast("bigint")), F.lit(0)).cast("bigint").alias(alias)
    return flagged.agg(
        n("_upd", "updated"), n("_ins", "inserted"), n("_act", "activity_set"),
        n("_del", "soft_deleted"), n("_clr", "revoke_cleared"),
    )
