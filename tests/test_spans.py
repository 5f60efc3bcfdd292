"""Validity spans and as-of joins, against loops over plain rows."""

import datetime as dt
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from sysledger import fixtures as fx
from sysledger.operators import spans
from sysledger.plans import scenarios as sc
from sysledger.plans import skew
from sysledger.schemas import USER_SPANS

T0 = dt.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else T0 + dt.timedelta(hours=hours)


def random_case(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for u in range(12):
        t = rng.randrange(0, 50)
        for _ in range(rng.randrange(0, 5)):
            end = t + rng.randrange(0, 400)
            rows.append((f"u{u}", rng.randrange(5), at(t), at(None if rng.random() < 0.2 else end)))  # some overlap
            t = end - rng.choice([0, 0, 30])
    rows += [("u1", 7, at(10), at(10)), ("u2", 8, at(500), at(90)), ("u3", 1, None, None), (None, 2, at(0), None), ("u4", None, at(3), at(9))]
    events = [(i, "u0" if i % 3 == 0 else rng.choice([f"u{rng.randrange(14)}", None]), at(rng.choice([None, *range(-20, 1500)])) if i % 11 else None)
              for i in range(n)]
    return rows, events


def expected(rows, events):
    best = {}
    for name, uid, start, end in rows:
        if name is not None and start is not None:
            entry = (uid is not None, uid or 0, end is None, end or T0, uid, end)
            best[name, start] = max(best.get((name, start), (False, -1, False, T0, None, None)), entry, key=lambda e: e[:4])
    cut = []
    for (name, start), (*_, uid, end) in best.items():
        later = [s for n, s in best if n == name and s > start]
        ends = [x for x in [end, *([min(later)] if later else [])] if x is not None]
        cut.append((name, uid, start, min(ends) if ends else None))
    out = []
    for i, name, t in events:
        hit = [s for s in cut if t is not None and s[0] == name and s[2] <= t and (s[3] is None or t < s[3])]
        assert len(hit) <= 1
        out.append((i, name, t, *(hit[0][1:] if hit else (None, None, None))))
    return sorted(out)


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_as_of_against_a_loop(spark, monkeypatch, seed, broadcast):
    rows, events = random_case(seed)
    span_df = spark.createDataFrame(rows, USER_SPANS)
    event_df = spark.createDataFrame(events, "id long, username string, t timestamp_ntz")
    if not broadcast:  # dealt by bucket, the hot user's buckets in pieces
        monkeypatch.setattr(skew, "fits_broadcast", lambda *a, **k: False)
    got = spans.as_of(event_df, "username", "t", span_df, "id", bucket_days=2, max_broadcast_bytes=None if broadcast else 0)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == expected(rows, events)
    none = spans.as_of(event_df.limit(0), "username", "t", span_df, "id", max_broadcast_bytes=0)
    assert none.columns == got.columns and none.collect() == []


def test_attribution_follows_recreated_and_renamed_users(spark):
    t = at
    people = spark.createDataFrame([("ann", 1, t(0), t(24)), ("ann", 9, t(48), None), ("bob", 2, t(0), t(24)), ("bobby", 2, t(24), None)], USER_SPANS)
    sessions = spark.createDataFrame([(1, "ann", "db"), (2, "bob", "db"), (3, "nobody", "db")], "sessionid long, username string, dbname string")
    statements = spark.createDataFrame(
        [(1, 1, t(10), t(11)), (2, 1, t(24), t(25)), (3, 1, t(48), None), (4, 2, t(3), t(4)), (5, 3, t(3), t(4)), (6, 77, t(3), t(4)), (7, None, t(3), None)],
        "statementid long, sessionid long, starttime timestamp_ntz, endtime timestamp_ntz")
    got = {r.statementid: (r.username, r.userid, r.name_now, r.user_dropped) for r in spans.attribute_as_of(statements, sessions, people).collect()}
    assert got == {1: ("ann", 1, "ann", True), 2: ("ann", None, None, None), 3: ("ann", 9, "ann", False), 4: ("bob", 2, "bobby", True),
                   5: ("nobody", None, None, None), 6: (None, None, None, None), 7: (None, None, None, None)}


def test_every_statement_once(spark):
    got = sc.q_attribution_as_of(spark, SF_SMALL)
    assert got.count() == got.select("statementid").distinct().count() == fx.statements_src(spark, SF_SMALL).count()


def test_split_join_gives_no_task_a_hot_key(spark):
    """A key with a third of the rows comes out of many tasks."""
    left = spark.range(30_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    right = spark.range(0, 30_000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for how in ("left", "inner"):
            got = skew.join_split(left, right, ["k"], "id", how=how, max_broadcast_bytes=0)
            per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
            assert max(per_task) < 0.1 * 30_000, max(per_task)
            want = left.join(right, "k", how).select("id", "k", "v")
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        nulls = left.withColumn("k", F.when(F.col("id") % 5 == 0, F.col("k")))
        got = skew.join_split(nulls, right, ["k"], "id", max_broadcast_bytes=0)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, nulls.join(right, "k", "left").select("id", "k", "v").collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
