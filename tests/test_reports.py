"""Documented uses (U1-U4) against brute force on small inputs."""

from __future__ import annotations

import datetime as dt
import random

from sysledger.operators import reports


def brute_gaps(times, width_s):
    ts = sorted(t for t in times if t is not None)
    out = []
    for a, b in zip(ts, ts[1:]):
        us = (b - a) // dt.timedelta(microseconds=1)
        if us > width_s * 1_000_000:
            out.append((a, b, us))
    return out


def test_capture_gaps_equals_brute_force(spark):
    rng = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    t = base
    times = []
    for _ in range(3000):
        t += dt.timedelta(microseconds=int(rng.expovariate(1 / 1200) * 1_000_000))
        times.append(t)
    times += [times[10]] * 50 + [None] * 3  # a dense instant and nulls
    df = spark.createDataFrame([(x,) for x in times], "ts timestamp_ntz")
    for width in (60, 3600, 7200):
        got = sorted(tuple(r) for r in reports.capture_gaps(df, "ts", width).collect())
        assert got == brute_gaps(times, width)


def test_capture_gaps_exact_width_is_not_a_gap(spark):
    a = dt.datetime(2024, 1, 1, 0, 0, 0)
    df = spark.createDataFrame([(a,), (a + dt.timedelta(hours=1),), (a + dt.timedelta(hours=2, microseconds=1),)],
                               "ts timestamp_ntz")
    got = [tuple(r) for r in reports.capture_gaps(df, "ts", 3600).collect()]
    assert got == [(a + dt.timedelta(hours=1), a + dt.timedelta(hours=2, microseconds=1), 3_600_000_001)]


def test_long_running_threshold_inclusive(spark):
    a = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, 1, a, a + dt.timedelta(seconds=300)), (2, 1, a, a + dt.timedelta(seconds=299)),
                                (3, 1, a, None)], "statementid long, sessionid long, starttime timestamp_ntz, endtime timestamp_ntz")
    assert [r.statementid for r in reports.long_running(df, 300).collect()] == [1]


def test_attribution_keeps_statements_without_session(spark):
    st = spark.createDataFrame([(1, 100, None, None), (2, 999, None, None)],
                               "statementid long, sessionid long, starttime timestamp_ntz, endtime timestamp_ntz")
    se = spark.createDataFrame([(100, "bob", "db")], "sessionid long, username string, dbname string")
    us = spark.createDataFrame([(5, "bob", dt.datetime(2024, 1, 1))], "userid int, username string, delete_time timestamp_ntz")
    got = {r.statementid: (r.username, r.userid, r.user_deleted) for r in reports.statement_attribution(st, se, us).collect()}
    assert got == {1: ("bob", 5, True), 2: (None, None, None)}


def test_inactive_users_skips_exempt_deleted_revoked(spark):
    old = dt.datetime(2023, 1, 1)
    df = spark.createDataFrame(
        [(1, "a", old, old, None, None, False), (2, "b", old, old, None, None, True), (3, "c", old, old, old, None, False),
         (4, "d", old, old, None, old, False), (5, "e", old, dt.datetime(2024, 1, 24, 12), None, None, False)],
        "userid int, username string, first_captured_time timestamp_ntz, last_activity_time timestamp_ntz, "
        "delete_time timestamp_ntz, connect_revoked_time timestamp_ntz, exempt_activity_flag boolean")
    got = [r.username for r in reports.inactive_users(df, "2024-01-25 00:00:00", 1).orderBy("userid").collect()]
    assert got == ["a"]


def test_capture_gaps_by_group_equals_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for g in ("a", "b"):
        t = dt.datetime(2024, 1, 1)
        for _ in range(800):
            t += dt.timedelta(seconds=rng.expovariate(1 / 1800))
            rows.append((g, t))
    df = spark.createDataFrame(rows, "g string, ts timestamp_ntz")
    got = sorted(tuple(r) for r in reports.capture_gaps(df, "ts", 3600, by=["g"]).collect())
    want = sorted((g, *x) for g in ("a", "b") for x in brute_gaps([t for gg, t in rows if gg == g], 3600))
    assert got == want


def test_run_gaps_flags_runs_more_than_72h_apart(spark):
    runs = [("capture_statements", dt.datetime(2024, 1, d, 1, 2)) for d in (1, 2, 3, 7, 8)] + \
           [("capture_sessions", dt.datetime(2024, 1, d, 1, 0)) for d in (1, 4, 5)]
    log = spark.createDataFrame(runs, "job string, run_ts timestamp_ntz")
    got = sorted((r.job, r.gap_start.day, r.gap_end.day) for r in reports.run_gaps(log).collect())
    # runs must be less than 72 hours apart, so exactly 72 is reported
    assert got == [("capture_sessions", 1, 4), ("capture_statements", 3, 7)]
    close = [("j", dt.datetime(2024, 1, 1)), ("j", dt.datetime(2024, 1, 3, 23, 59, 59, 999999))]
    assert reports.run_gaps(spark.createDataFrame(close, "job string, run_ts timestamp_ntz")).count() == 0
