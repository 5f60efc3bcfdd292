"""Hot keys: one session holding a third of all statements, one user a
third of all sessions. Results stay exact; the shuffled join is split by
AQE and the per-user reduction is partial-aggregated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from sysledger.operators import reports, users
from sysledger.schemas import USERS, USERS_HISTORY

N = 30_000
BASE = dt.datetime(2024, 1, 1)


def _statements(spark):
    # ids below N/3 all belong to session 0 (the hot session)
    ids = spark.range(N).withColumnRenamed("id", "statementid")
    return ids.select(
        "statementid",
        F.when(F.col("statementid") < N // 3, F.lit(0)).otherwise(F.col("statementid") % 997 + 1).alias("sessionid"),
        F.timestamp_add("SECOND", F.col("statementid"), F.lit(BASE).cast("timestamp_ntz")).alias("starttime"),
        F.timestamp_add("SECOND", F.col("statementid") + 5, F.lit(BASE).cast("timestamp_ntz")).alias("endtime"),
    )


def _sessions(spark):
    ids = spark.range(998).withColumnRenamed("id", "sessionid")
    return ids.select("sessionid", F.concat(F.lit("u"), (F.col("sessionid") % 50).cast("string")).alias("username"),
                      F.lit("db").alias("dbname"))


def _final_plan(df) -> str:
    """Run the DataFrame's own plan, so its adaptive plan is finalized."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_session_join_is_split_and_exact(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        us = spark.createDataFrame([(i, f"u{i}", None) for i in range(50)], "userid int, username string, delete_time timestamp_ntz")
        out = reports.statement_attribution(_statements(spark), _sessions(spark), us)
        plan = _final_plan(out)
        assert "SortMergeJoin" in plan and "skew=true" in plan
        got = out.groupBy("username").count()
        want = (_statements(spark).join(_sessions(spark), "sessionid", "left").groupBy("username").count())
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert out.count() == N
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_user_sessions_reduce_before_join(spark):
    # user "hot" has a third of all sessions
    sessions = spark.range(N).select(
        F.when(F.col("id") < N // 3, F.lit("hot")).otherwise(F.concat(F.lit("u"), (F.col("id") % 100).cast("string"))).alias("username"),
        F.timestamp_add("SECOND", F.col("id"), F.lit(BASE).cast("timestamp_ntz")).alias("starttime"),
        F.when(F.col("id") % 7 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.timestamp_add("SECOND", F.col("id") + 60, F.lit(BASE).cast("timestamp_ntz"))).alias("endtime"),
    )
    names = ["hot"] + [f"u{i}" for i in range(100)]
    t0 = dt.datetime(2023, 1, 1)
    hist = spark.createDataFrame([(i, n, None, False, False, True, -1, t0, t0, None, BASE, False, None, None, None)
                                  for i, n in enumerate(names)], USERS_HISTORY)
    src = spark.createDataFrame([(i, n, None, False, False, True, -1) for i, n in enumerate(names)], USERS)
    run = dt.datetime(2024, 2, 1)
    out = users.sync_users(hist, src, sessions, run)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan
    got = {r.username: (r.last_activity_time, r.connect_revoked_time) for r in out.collect()}
    rows = sessions.collect()
    for name in names:
        mine = [r for r in rows if r.username == name]
        la = max(r.endtime or run for r in mine)
        assert got[name][0] == la
        assert got[name][1] is None  # every user has a session after the revocation
