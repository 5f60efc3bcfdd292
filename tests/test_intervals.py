"""Merged intervals, derived session ends and inactive stretches, against loops."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from sysledger.operators import intervals

T0 = dt.datetime(2024, 1, 1)


def t(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def union(rows, gap):
    """(key, from, to, n) by a sorted sweep."""
    by = defaultdict(list)
    for key, start, end in rows:
        if key is not None and start is not None:
            by[key].append((start, max(start, end if end is not None else start)))
    out = []
    for key, spans in by.items():
        last = None
        for s, e in sorted(spans):
            if last is None or s > last[2] + dt.timedelta(seconds=gap):
                last = [key, s, e, 0]
                out.append(last)
            last[2], last[3] = max(last[2], e), last[3] + 1
    return sorted(map(tuple, out))


@pytest.mark.parametrize("gap", [0, 1, 7, 3600])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merged_intervals_against_a_sweep(spark, monkeypatch, seed, gap):
    monkeypatch.setattr(intervals, "BUCKETS_PER_PIECE", 3)  # many pieces, islands over them
    monkeypatch.setattr(intervals, "TOUCHING_PIECE_SECONDS", 50)
    rng = random.Random(seed)
    rows = []
    for i in range(700):
        s = rng.randrange(0, rng.choice([500, 5000, 200_000]))
        e = s + rng.choice([0, 0, 1, 5, 30, 400, 20_000]) * (rng.random() < 0.9) - (rng.random() < 0.05) * 9
        rows.append((0 if i % 3 == 0 else rng.choice([1, 2, 3, None]), t(s if i % 50 else None), t(e) if i % 17 else None))
    df = spark.createDataFrame(rows, "k int, s timestamp_ntz, e timestamp_ntz")
    got = intervals.merged_intervals(df, ["k"], "s", "e", gap)
    assert sorted(map(tuple, got.select("k", "merged_from", "merged_to", "n").collect())) == union(rows, gap)
    assert intervals.merged_intervals(df.limit(0), ["k"], "s", "e", gap).collect() == []


def test_closed_sessions(spark):
    now, gap = t(100_000), 600
    sessions = [(1, "a", "d", t(0), t(50)), (2, "b", "d", t(0), None), (3, "c", "d", t(0), None), (4, "d", "d", t(99_900), None),
                (5, "e", "d", t(10), None), (6, "f", "d", None, None), (7, "g", "d", t(5), None)]
    work = [(1, 2, t(0), t(100)), (2, 2, t(50), t(300)), (3, 2, t(5000), t(5100)), (4, 3, t(99_000), t(99_500)), (5, 5, t(20), None),
            (6, 1, t(0), t(99_999)), (7, 7, t(99_000), t(200_000)), (8, 99, t(0), t(1)), (9, None, t(0), t(1)), (10, 2, t(150_000), t(150_001))]
    s = spark.createDataFrame(sessions, "sessionid long, username string, dbname string, starttime timestamp_ntz, endtime timestamp_ntz")
    w = spark.createDataFrame(work, "statementid long, sessionid long, starttime timestamp_ntz, endtime timestamp_ntz")
    got = {r.sessionid: (r.effective_end, r.end_source, r.bursts, r.busy_us) for r in intervals.closed_sessions(s, w, now, gap).collect()}
    assert got == {1: (t(50), "recorded", 0, 0), 2: (t(5100), "derived", 2, 400_000_000), 3: (None, "open", 1, 500_000_000), 4: (None, "open", 0, 0),
                   5: (None, "open", 1, 99_980_000_000), 6: (None, "open", 0, 0), 7: (None, "open", 1, 1_000_000_000)}


def test_inactive_stretches(spark):
    day = 86_400
    users = [("never", 1, t(0), None, False), ("gone", 2, t(0), t(5 * day), False), ("exempt", 3, t(0), None, True), ("busy", 4, t(0), None, None)]
    u = spark.createDataFrame(users, "username string, userid int, first_captured_time timestamp_ntz, delete_time timestamp_ntz, exempt_activity_flag boolean")
    sessions = [("busy", t(2 * day), t(2 * day + 60)), ("busy", t(2 * day + 30), t(3 * day)), ("busy", t(4 * day), t(4 * day + 1)), ("busy", t(9 * day), None),
                ("gone", t(1 * day), t(1 * day + 10)), ("gone", t(7 * day), t(8 * day)), ("exempt", t(0), t(1))]
    s = spark.createDataFrame(sessions, "username string, starttime timestamp_ntz, endtime timestamp_ntz")
    got = sorted((r.username, r.kind, r.idle_from, r.idle_to, r.idle_us) for r in intervals.inactive_stretches(s, u, t(10 * day), day).collect())
    us = 1_000_000
    assert got == [("busy", "before", t(0), t(2 * day), 2 * day * us), ("busy", "between", t(3 * day), t(4 * day), day * us),
                   ("busy", "between", t(4 * day + 1), t(9 * day), (5 * day - 1) * us), ("gone", "before", t(0), t(day), day * us),
                   ("gone", "between", t(day + 10), t(5 * day), (4 * day - 10) * us), ("never", "never", t(0), t(10 * day), 10 * day * us)]
