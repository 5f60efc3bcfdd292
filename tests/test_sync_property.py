"""The fused user sync equals a plain-Python model of the five statements
applied one after another, on small random tables (null paths and ids,
shared userids, renamed and deleted users, open sessions)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sysledger.operators import users
from sysledger.schemas import USERS, USERS_HISTORY

RUN = dt.datetime(2024, 1, 25, 0, 0, 0, 500000)
T0 = dt.datetime(2024, 1, 10)
NAMES = ["a", "b", "c", "d", "e"]


def ts(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


hist_row = st.tuples(
    st.sampled_from([1, 2, 3, None]),  # userid (shared ids possible)
    st.sampled_from(NAMES),
    st.sampled_from(["{p}", "{q}", None]),
    st.booleans(),
    st.sampled_from([-1, 0, 5]),
    st.sampled_from([None, 1, 50]),  # delete_time hours
    st.sampled_from([None, 2, 200]),  # connect_revoked_time hours
)
src_row = st.tuples(st.sampled_from([1, 2, 3, 4, None]), st.sampled_from(["{p}", "{q}", None]), st.booleans(),
                    st.sampled_from([-1, 0, 5]))
sess_row = st.tuples(st.sampled_from(NAMES + ["zz"]), st.integers(0, 300), st.sampled_from([None, 1, 30]))


def model(hist, src, sess):
    """The five statements on Python rows, in order."""
    h = [dict(r) for r in hist]
    by_name = {s["username"]: s for s in src}
    # 1. update changed (!= with nulls unknown), resurrect
    for r in h:
        n = by_name.get(r["username"])
        if n is None:
            continue

        def ne(a, b):
            return a is not None and b is not None and a != b
        changed = any(ne(r[c], n[c]) for c in ("userid", "schemapath", "cancreaterole", "cancreatedb",
                                                "autoinheritgrouppriv", "connlimit")) or r["delete_time"] is not None
        if changed:
            for c in ("userid", "schemapath", "cancreaterole", "cancreatedb", "autoinheritgrouppriv", "connlimit"):
                r[c] = n[c]
            r["delete_time"] = None
    # 2. insert new usernames
    known = {r["username"] for r in h}
    for n in src:
        if n["username"] not in known:
            h.append({**n, "first_captured_time": RUN, "last_activity_time": RUN, "delete_time": None,
                      "connect_revoked_time": None, "exempt_activity_flag": False, "security_unique_id": None,
                      "email_address": None, "full_username": None})
    # 3. last activity by username
    for r in h:
        mine = [s for s in sess if s["username"] == r["username"]]
        if mine:
            r["last_activity_time"] = max(s["endtime"] or RUN for s in mine)
    # 4. soft delete by userid
    src_ids = {n["userid"] for n in src if n["userid"] is not None}
    gone_ids = {r["userid"] for r in h if r["userid"] not in src_ids}
    for r in h:
        if r["userid"] is not None and r["userid"] in gone_ids and r["delete_time"] is None:
            r["delete_time"] = RUN
    # 5. clear revocation for every row of a userid with a later session
    ids = {r["userid"] for r in h for s in sess
           if s["username"] == r["username"] and r["connect_revoked_time"] is not None
           and s["starttime"] is not None and r["connect_revoked_time"] < s["starttime"]}
    for r in h:
        if r["userid"] is not None and r["userid"] in ids:
            r["connect_revoked_time"] = None
    return h


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(hist_row, max_size=6), st.lists(src_row, max_size=5), st.lists(sess_row, max_size=6),
       st.permutations(NAMES))
def test_fused_sync_equals_statement_model(spark, hist_rows, src_rows, sess_rows, names):
    hist = []
    seen = set()
    for uid, name, path, role, conn, dt_h, rv_h in hist_rows:
        if name in seen:  # usernames unique in the history
            continue
        seen.add(name)
        hist.append({"userid": uid, "username": name, "schemapath": path, "cancreaterole": role, "cancreatedb": False,
                     "autoinheritgrouppriv": True, "connlimit": conn, "first_captured_time": T0,
                     "last_activity_time": T0, "delete_time": ts(dt_h), "connect_revoked_time": ts(rv_h),
                     "exempt_activity_flag": False, "security_unique_id": None, "email_address": None,
                     "full_username": name.upper()})
    src = [{"userid": uid, "username": names[i], "schemapath": path, "cancreaterole": role, "cancreatedb": False,
            "autoinheritgrouppriv": True, "connlimit": conn} for i, (uid, path, role, conn) in enumerate(src_rows)]
    sess = [{"username": n, "starttime": ts(h), "endtime": ts(None if e is None else h + e)} for n, h, e in sess_rows]

    hdf = spark.createDataFrame([tuple(r[f] for f in USERS_HISTORY.fieldNames()) for r in hist], USERS_HISTORY)
    sdf = spark.createDataFrame([tuple(r[f] for f in USERS.fieldNames()) for r in src], USERS)
    edf = spark.createDataFrame([(s["username"], s["starttime"], s["endtime"]) for s in sess],
                                "username string, starttime timestamp_ntz, endtime timestamp_ntz")
    got = sorted((tuple(r) for r in users.sync_users(hdf, sdf, edf, RUN).collect()), key=repr)
    want = sorted((tuple(r[f] for f in USERS_HISTORY.fieldNames()) for r in model(hist, src, sess)), key=repr)
    assert got == want
