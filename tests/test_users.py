"""User history sync (M3-M8, D4-D7, D15, D16) and the golden sample."""

from __future__ import annotations

import datetime as dt

from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F

from sysledger import fixtures as fx
from sysledger.operators import listings, users
from sysledger.plans import scenarios as sc
from sysledger.schemas import USERS, USERS_HISTORY

RUN = "2024-01-25 00:00:00.5"
NOW = dt.datetime(2024, 1, 25, 0, 0, 0, 500000)


def T(s):
    return dt.datetime.fromisoformat(s)


def sequential(h, n, s, run_ts):
    h = users.users_update_changed(h, n)
    h = users.users_insert_new(h, n, run_ts)
    h = users.users_last_activity(h, s, run_ts)
    h = users.users_soft_delete(h, n, run_ts)
    return users.users_clear_revoked(h, s, run_ts)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fused_equals_sequential_steps(spark):
    for sf in (SF_SMALL, SF_MID):
        h, n, s = fx.users_history(spark, sf), fx.staged_users(spark, sf), sc.user_rule_sessions(spark, sf)
        assert same(users.sync_users(h, n, s, fx.RUN_TS), sequential(h, n, s, fx.RUN_TS))


def test_counts_match_measured_branch_coverage(spark):
    got = sc.q_sync_user_counts(spark, SF_MID).first().asDict()
    assert got == {"updated": 344, "inserted": 77, "activity_set": 107, "soft_deleted": 68, "revoke_cleared": 34}
    out = sc.q_sync_users(spark, SF_MID)
    assert out.count() == 1677
    assert out.select("userid").distinct().count() == 1628


def test_last_activity_can_move_backwards(spark):
    before = fx.users_history(spark, SF_MID).select("username", F.col("last_activity_time").alias("b"))
    after = sc.q_sync_users(spark, SF_MID).select("username", F.col("last_activity_time").alias("a"))
    assert before.join(after, "username").where("a < b").count() == 25


def test_dba_columns_never_change(spark):
    cols = ["exempt_activity_flag", "security_unique_id", "email_address", "full_username"]
    before = fx.users_history(spark, SF_MID).select("username", *cols)
    after = sc.q_sync_users(spark, SF_MID).join(before.select("username"), "username").select("username", *cols)
    assert same(before, after)


def _hist(spark, rows):
    return spark.createDataFrame(rows, USERS_HISTORY)


def _users(spark, rows):
    return spark.createDataFrame(rows, USERS)


def _sessions(spark, rows):
    return spark.createDataFrame(rows, "username string, starttime timestamp_ntz, endtime timestamp_ntz")


BASE = (T("2023-01-01 00:00:00"), T("2023-06-01 00:00:00"))


def hist_row(uid, name, path="{p}", delete=None, revoked=None, last=None):
    return (uid, name, path, False, False, True, -1, BASE[0], last or BASE[1], delete, revoked, False, None, None, None)


def test_rename_adds_row_and_keeps_old_live(spark):
    h = _hist(spark, [hist_row(10, "old")])
    n = _users(spark, [(10, "new", "{p}", False, False, True, -1)])
    out = {r.username: r for r in users.sync_users(h, n, _sessions(spark, []), RUN).collect()}
    assert set(out) == {"old", "new"}
    assert out["old"].delete_time is None  # userid 10 still exists
    assert out["new"].first_captured_time == NOW


def test_reappearing_user_is_resurrected_keeping_first_capture(spark):
    h = _hist(spark, [hist_row(10, "bob", delete=T("2023-12-01 00:00:00"))])
    n = _users(spark, [(11, "bob", "{p}", False, False, True, -1)])
    r = users.sync_users(h, n, _sessions(spark, []), RUN).first()
    assert (r.userid, r.delete_time, r.first_captured_time) == (11, None, BASE[0])


def test_null_to_value_change_alone_is_not_detected(spark):
    h = _hist(spark, [hist_row(10, "bob", path=None)])
    n = _users(spark, [(10, "bob", "{sandbox}", False, False, True, -1)])
    r = users.sync_users_flagged(h, n, _sessions(spark, []), RUN).first()
    assert (r.schemapath, r._upd) == (None, False)


def test_empty_source_marks_every_live_user_deleted(spark):
    h = _hist(spark, [hist_row(10, "a"), hist_row(11, "b", delete=T("2023-02-01 00:00:00")), hist_row(None, "c")])
    out = {r.username: r.delete_time for r in users.sync_users(h, _users(spark, []), _sessions(spark, []), RUN).collect()}
    assert out == {"a": NOW, "b": T("2023-02-01 00:00:00"), "c": None}


def test_revocation_cleared_for_every_row_of_the_userid(spark):
    h = _hist(spark, [hist_row(10, "a", revoked=T("2024-01-01 00:00:00")), hist_row(10, "a2", revoked=T("2024-01-01 00:00:00")),
                      hist_row(12, "c", revoked=T("2024-01-05 00:00:00"))])
    n = _users(spark, [(10, "a", "{p}", False, False, True, -1), (10, "a2", "{p}", False, False, True, -1),
                       (12, "c", "{p}", False, False, True, -1)])
    s = _sessions(spark, [("a", T("2024-01-02 00:00:00"), None), ("c", T("2024-01-04 00:00:00"), T("2024-01-04 01:00:00"))])
    out = {r.username: r for r in users.sync_users(h, n, s, RUN).collect()}
    assert out["a"].connect_revoked_time is None and out["a2"].connect_revoked_time is None
    assert out["c"].connect_revoked_time == T("2024-01-05 00:00:00")
    # open session counts as active now; a finished one gives its end
    assert out["a"].last_activity_time == NOW
    assert out["c"].last_activity_time == T("2024-01-04 01:00:00")


def test_set_user_attributes_edits_only_named_users(spark):
    h = _hist(spark, [hist_row(10, "a"), hist_row(11, "b")])
    edits = spark.createDataFrame([("a", "Ann A", True)], "username string, full_username string, exempt_activity_flag boolean")
    out = {r.username: r for r in users.set_user_attributes(h, edits).collect()}
    assert (out["a"].full_username, out["a"].exempt_activity_flag) == ("Ann A", True)
    assert (out["b"].full_username, out["b"].exempt_activity_flag) == (None, False)


# A users listing: one row of each kind, in username order.
LISTED = [
    (501, "batch", None, False, False, True, 4, "2024-02-01 00:00:00.25", None, True, "Nightly batch"),
    (77, "hr_reader", "{hr}", False, False, False, 0, "2024-02-03 10:20:30", None, False, "Reader of HR"),
    (9, "ops", "{ops,public}", True, False, True, -1, "2024-01-31 23:59:59.999999", None, True, None),
    (310, "trainee", "{public}", False, True, True, 1, "2024-01-05 07:00:00", "2024-01-20 12:00:00.5", False, "A trainee"),
]


def test_users_listing_order_and_columns(spark):
    first = T("2023-11-11 11:11:11.111111")
    rows = [(u, n, p, cr, cd, ai, cl, first, T(last), T(d) if d else None, None, ex, None, f"{n}@example.com", full)
            for (u, n, p, cr, cd, ai, cl, last, d, ex, full) in LISTED]
    h = spark.createDataFrame(list(reversed(rows)), USERS_HISTORY)
    out = listings.list_users_history(h, ordered=True)
    assert out.columns == listings.USER_HISTORY_COLUMNS
    got = [tuple(r) for r in out.collect()]
    assert [g[1] for g in got] == ["batch", "hr_reader", "ops", "trainee"]
    assert got[3][9] == T("2024-01-20 12:00:00.5")
