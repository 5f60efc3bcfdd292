"""Jobs over their tables (B1-B4, W1, W3, W6): merges by dynamic partition
overwrite, overlapping jobs, recovery."""

from __future__ import annotations

import uuid

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from sysledger import fixtures as fx
from sysledger.operators import capture, users
from sysledger.plans import jobs
from sysledger.plans import scenarios as sc
from sysledger.schemas import SESSIONS, STATEMENTS
from sysledger.sinks.export import export_text, read_export
from sysledger.sinks.tables import RunLog, Tables, default_root


@pytest.fixture()
def store(spark):
    return Tables(default_root(spark, f"store-{uuid.uuid4().hex[:8]}"))


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def seed(spark, store, name, df):
    store.seed(spark, name, df)


def files(spark, store, name):
    """partition -> its files."""
    out = {}
    for f in spark.read.parquet(store.path(name)).inputFiles():
        out.setdefault(f.split("/")[-2].split("=")[1], set()).add(f)
    return out


def test_capture_job_equals_operator_merge(spark, store):
    seed(spark, store, "statements_history", fx.statements_history(spark, SF_SMALL))
    m = jobs.capture_statements(spark, store, fx.statements_src(spark, SF_SMALL), fx.RUN_TS).first()
    assert (m.extracted, m.inserted, m.updated) == (299, 298, 1)
    assert same(store.read(spark, "statements_history"), sc.merged_statements(spark, SF_SMALL))


def test_three_nights_equal_one_shot(spark, store):
    src = fx.statements_src(spark, SF_SMALL)
    for night in ("2024-01-08 01:02:00.25", "2024-01-19 01:02:00.5", "2024-02-01 01:02:00"):
        jobs.capture_statements(spark, store, src, night)
    one_shot = capture.merge_upsert(spark.createDataFrame([], STATEMENTS),
                                    capture.extract_statements(src, "2000-01-01 00:00:00", "2024-02-01 01:02:00"),
                                    "statementid")
    assert same(store.read(spark, "statements_history"), one_shot)
    log = store.run_log(spark).where("job = 'capture_statements'").orderBy("run_ts").collect()
    assert len(log) == 3 and all(r.extracted == r.inserted + r.updated for r in log)
    assert sum(r.inserted for r in log) == one_shot.count()


def test_rerun_same_night_changes_nothing(spark, store):
    src = fx.statements_src(spark, SF_SMALL)
    jobs.capture_statements(spark, store, src, fx.RUN_TS)
    before = store.read(spark, "statements_history")
    snapshot = before.collect()
    m = jobs.capture_statements(spark, store, src, fx.RUN_TS).first()
    assert m.inserted == 0
    assert same(store.read(spark, "statements_history"), spark.createDataFrame(snapshot, STATEMENTS))


def test_merge_rewrites_only_touched_partitions(spark, store):
    seed(spark, store, "statements_history", fx.statements_history(spark, SF_SMALL))
    before = files(spark, store, "statements_history")
    jobs.capture_statements(spark, store, fx.statements_src(spark, SF_SMALL), fx.RUN_TS)
    after = files(spark, store, "statements_history")
    # days before the watermark's day keep their files
    assert {p for p in before if before[p] == after.get(p)} == {p for p in before if p < "2024-01-14"}


def test_failed_run_publishes_nothing(spark, store):
    seed(spark, store, "statements_history", fx.statements_history(spark, SF_SMALL))
    before = files(spark, store, "statements_history")
    bad = fx.statements_src(spark, SF_SMALL).withColumn("iscancelable", F.lit("maybe"))
    with pytest.raises(Exception):
        jobs.capture_statements(spark, store, bad, fx.RUN_TS)
    assert files(spark, store, "statements_history") == before
    # a key staged twice fails the merge, not only the extract
    twice = fx.statements_src(spark, SF_SMALL)
    with pytest.raises(Exception, match="duplicate staged statementid"):
        jobs.capture_statements(spark, store, twice.union(twice), fx.RUN_TS)
    assert same(store.read(spark, "statements_history"), fx.statements_history(spark, SF_SMALL))
    assert not store.recover(spark, "statements_history")


def test_sessions_users_run_matches_operators(spark, store):
    seed(spark, store, "sessions_history", fx.sessions_history(spark, SF_SMALL))
    seed(spark, store, "users_history", fx.users_history(spark, SF_SMALL))
    metrics = jobs.capture_sessions_users(spark, store, fx.sessions_src(spark, SF_SMALL), fx.users_src(spark, SF_SMALL),
                                          fx.RUN_TS)
    by_step = {(r.job, r.step): r for r in metrics.collect()}
    staged = store.read(spark, "sessions_new")
    expected = users.sync_users(fx.users_history(spark, SF_SMALL), fx.staged_users(spark, SF_SMALL), staged, fx.RUN_TS)
    assert same(store.read(spark, "users_history"), expected)
    assert by_step[("sync_users", "insert_new")].inserted == 30
    assert by_step[("sync_users", "soft_delete")].updated == 6
    assert by_step[("capture_sessions", "merge")].extracted == staged.count()


def test_empty_user_source_can_be_refused(spark, store):
    seed(spark, store, "users_history", fx.users_history(spark, SF_SMALL))
    empty = fx.users_src(spark, SF_SMALL).where("false")
    with pytest.raises(RuntimeError, match="no users"):
        jobs.sync_users(spark, store, empty, fx.RUN_TS, require_users=True)


def test_compact_keeps_rows(spark, store):
    src = fx.statements_src(spark, SF_SMALL)
    for night in ("2024-01-08 00:00:00", "2024-01-19 00:00:00"):
        jobs.capture_statements(spark, store, src, night)
    before = store.read(spark, "statements_history").collect()
    jobs.compact(spark, store, "statements_history")
    assert same(store.read(spark, "statements_history"), spark.createDataFrame(before, STATEMENTS))


def test_export_round_trip(spark):
    from sysledger.session import checkpoint_dir

    path = f"{checkpoint_dir(spark)}/export-{uuid.uuid4().hex[:8]}"
    df = sc.q_list_views(spark, SF_SMALL)
    export_text(df, path)
    back = read_export(spark, path, df.schema)
    assert same(back, df)


def test_merge_moves_key_across_days_and_empties_the_old_day(spark, store):
    import datetime as dt

    t = dt.datetime.fromisoformat
    hist = spark.createDataFrame([(1, 1, 1, 0, "old", t("2024-01-01 10:00:00"), t("2024-01-01 10:00:01"), True),
                                  (2, 1, 1, 0, "keep", t("2024-01-02 10:00:00"), t("2024-01-02 10:00:01"), True),
                                  (5, 1, 1, 0, "no end", t("2024-01-02 10:00:00"), None, True)],
                                 STATEMENTS)
    seed(spark, store, "statements_history", hist)
    moved = spark.createDataFrame([(1, 9, 9, 1, "new", t("2024-01-03 10:00:00"), t("2024-01-03 10:00:01"), False),
                                   (5, 9, 9, 1, "ended", t("2024-01-02 10:00:00"), t("2024-01-02 11:00:01"), False),
                                   (None, 9, 9, 1, "no key", t("2024-01-03 10:00:00"), t("2024-01-03 10:00:01"), False)],
                                  STATEMENTS)
    staged = store.stage_merge(spark, "statements_history", store.replace_staging(spark, "statements_new", moved), "test")
    assert staged.counts == {"extracted": 3, "inserted": 1, "updated": 2}
    assert staged.parts == ["2024-01-01", "2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__"]
    for _ in range(2):  # publishing may be repeated
        store.publish(spark, staged)
        got = sorted((r.statementid or 0, r.statement) for r in store.read(spark, "statements_history").collect())
        assert got == [(0, "no key"), (1, "new"), (2, "keep"), (5, "ended")]


def test_compact_selected_partitions_keeps_the_others(spark, store):
    src = fx.statements_src(spark, SF_SMALL)
    jobs.capture_statements(spark, store, src, "2024-01-19 00:00:00")
    before_files = files(spark, store, "statements_history")
    before = store.read(spark, "statements_history").collect()
    chosen = sorted(before_files)[:3]
    jobs.compact(spark, store, "statements_history", rows_per_file=10, parts=chosen)
    after_files = files(spark, store, "statements_history")
    assert set(after_files) == set(before_files)
    assert all(after_files[p] != before_files[p] for p in chosen) and sum(len(after_files[p]) for p in chosen) > 3
    assert all(after_files[p] == before_files[p] for p in before_files if p not in chosen)
    assert same(store.read(spark, "statements_history"), spark.createDataFrame(before, STATEMENTS))


def test_read_since_skips_older_partitions(spark, store):
    seed(spark, store, "statements_history", fx.statements_history(spark, SF_SMALL))
    all_rows = store.read(spark, "statements_history")
    recent = store.read(spark, "statements_history", since="2024-01-10 12:00:00", since_col="endtime")
    # a bound on a column the table is not partitioned by prunes nothing
    assert store.read(spark, "statements_history", since="2024-01-10 12:00:00", since_col="starttime").count() \
        == all_rows.count()
    assert recent.where("endtime < timestamp_ntz'2024-01-10 00:00:00'").count() == 0
    want = all_rows.where("endtime > timestamp_ntz'2024-01-10 12:00:00'")
    assert same(recent.where("endtime > timestamp_ntz'2024-01-10 12:00:00'"), want)


def test_three_nights_of_sessions_and_users_equal_operator_sequence(spark, store):
    ses_src, usr_src = fx.sessions_src(spark, SF_SMALL), fx.users_src(spark, SF_SMALL)
    seed(spark, store, "users_history", fx.users_history(spark, SF_SMALL))
    hist_s = spark.createDataFrame([], SESSIONS)
    hist_u = fx.users_history(spark, SF_SMALL)
    for night in ("2024-01-10 01:00:00.25", "2024-01-20 01:00:00.5", "2024-01-31 01:00:00"):
        jobs.capture_sessions_users(spark, store, ses_src, usr_src, night)
        low = capture.watermark_value(hist_s, "starttime")
        staged = capture.extract_sessions(ses_src, low, capture.upper_bound(night))
        hist_s = capture.merge_upsert(hist_s, staged, "sessionid")
        hist_u = users.sync_users(hist_u, capture.extract_users(usr_src), staged, night)
        # materialize each night's state so the next night builds on data, not a growing plan
        hist_s = spark.createDataFrame(hist_s.collect(), SESSIONS)
        hist_u = spark.createDataFrame(hist_u.collect(), hist_u.schema)
    assert same(store.read(spark, "sessions_history"), hist_s)
    assert same(store.read(spark, "users_history"), hist_u)
    assert store.run_log(spark).where("job = 'capture_sessions'").count() == 3


def test_watermark_of_recent_and_of_old_histories(spark, store):
    import datetime as dt

    assert store.watermark(spark, "statements_history", fx.RUN_TS) == dt.datetime(2000, 1, 1)
    hist = fx.statements_history(spark, SF_SMALL)
    seed(spark, store, "statements_history", hist)
    want = capture.watermark_value(hist, "endtime")
    assert store.watermark(spark, "statements_history", fx.RUN_TS) == want
    assert store.watermark(spark, "statements_history", "2026-01-01 00:00:00") == want  # nothing in the last days
    assert store.watermark(spark, "statements_history", "2020-01-01 00:00:00") == want  # rows after the run count


def test_lost_driver_is_made_good_by_the_next_run(spark, store):
    """A run that died after staging, or in the middle of publishing."""
    seed(spark, store, "statements_history", fx.statements_history(spark, SF_SMALL))
    steps = jobs.statements_steps(spark, store, fx.statements_src(spark, SF_SMALL), fx.RUN_TS)
    assert [next(steps), next(steps)] == ["extracted", "merged"]
    steps.close()
    # one of its days is gone: deleted, its new files not yet in place
    store_path = f"{store.path('statements_history')}/end_date=2024-01-14"
    spark.createDataFrame([], STATEMENTS).write.mode("overwrite").parquet(store_path)
    # a later source that has purged everything of that run
    empty = fx.statements_src(spark, SF_SMALL).where("false")
    jobs.capture_statements(spark, store, empty, "2024-01-26 00:00:00")
    assert same(store.read(spark, "statements_history"), sc.merged_statements(spark, SF_SMALL))
    assert not store.recover(spark, "statements_history")


def test_log_only_run_does_not_meet_other_tables(spark, store):
    seed(spark, store, "users_history", fx.users_history(spark, SF_SMALL))
    staged = store.stage_replacement(spark, "users_history", store.read(spark, "users_history"), "edit_users")
    assert not store.recover(spark, "statements_history")
    store.publish(spark, staged, [RunLog("edit_users", "edits", None, extracted=0)])
    assert not store.recover(spark, "users_history")
    assert [(r.job, r.step) for r in store.run_log(spark).collect()] == [("edit_users", "edits")]


def test_user_sync_job_after_separate_session_capture(spark, store):
    seed(spark, store, "sessions_history", fx.sessions_history(spark, SF_SMALL))
    seed(spark, store, "users_history", fx.users_history(spark, SF_SMALL))
    jobs.capture_sessions(spark, store, fx.sessions_src(spark, SF_SMALL), fx.RUN_TS)  # B2
    metrics = {r.step: r for r in jobs.sync_users(spark, store, fx.users_src(spark, SF_SMALL), fx.RUN_TS).collect()}  # B3
    staged = store.read(spark, "sessions_new")
    want = users.sync_users(fx.users_history(spark, SF_SMALL), fx.staged_users(spark, SF_SMALL), staged, fx.RUN_TS)
    assert same(store.read(spark, "users_history"), want)
    assert metrics["extract_users"].extracted == fx.users_src(spark, SF_SMALL).count()
    assert metrics["update_changed"].updated == 38 and metrics["insert_new"].inserted == 30


def test_rerunning_sessions_users_with_same_time_can_lower_activity(spark, store):
    """D5: the second run stages only the last second's sessions, and the
    activity step overwrites (never maximises): those users' activity can
    only stay or move back."""
    seed(spark, store, "users_history", fx.users_history(spark, SF_SMALL))
    ses, usr = fx.sessions_src(spark, SF_SMALL), fx.users_src(spark, SF_SMALL)
    jobs.capture_sessions_users(spark, store, ses, usr, "2024-01-20 00:00:00")
    first = {r.username: r.last_activity_time for r in store.read(spark, "users_history").collect()}
    m = {(r.job, r.step): r for r in jobs.capture_sessions_users(spark, store, ses, usr, "2024-01-20 00:00:00").collect()}
    second = {r.username: r.last_activity_time for r in store.read(spark, "users_history").collect()}
    restaged = {r.username for r in store.read(spark, "sessions_new").collect()}
    assert m[("capture_sessions", "merge")].extracted == len(store.read(spark, "sessions_new").collect()) <= 1
    assert m[("sync_users", "last_activity")].updated == len(restaged & set(second))
    changed = {u for u in first if second[u] != first[u]}
    assert changed <= restaged
    assert all(second[u] < first[u] for u in changed)


def test_jobs_overlap_in_every_order(spark):
    """Statement job and session/user job, their steps interleaved in every
    order: the tables are the ones of a serial run. (Steps that only read are
    joined to the next write.)"""
    from itertools import combinations

    src, ses, usr = (f(spark, SF_SMALL).cache() for f in (fx.statements_src, fx.sessions_src, fx.users_src))
    hist = {n: f(spark, SF_SMALL).cache() for n, f in sc.SEEDS.items()}
    want_statements = sorted(map(tuple, sc.merged_statements(spark, SF_SMALL).collect()))
    want_users = sorted(map(tuple, users.sync_users(hist["users_history"], fx.staged_users(spark, SF_SMALL), sc.staged_sessions(spark, SF_SMALL),
                                                    fx.RUN_TS).collect()), key=repr)
    assert len(want_users) == 190
    one_steps, two_steps = 3, 3  # B1: extracted, merged, published; B4: sessions published, users merged, users published
    for places in combinations(range(one_steps + two_steps), one_steps):
        store = Tables(default_root(spark, f"store-{uuid.uuid4().hex[:8]}"))
        for n, df in hist.items():
            store.seed(spark, n, df)
        one = jobs.statements_steps(spark, store, src, fx.RUN_TS)
        two = jobs.sessions_users_steps(spark, store, ses, usr, fx.RUN_TS)
        ends = iter(["published", "users merged", "users published"])
        for turn in range(one_steps + two_steps):
            if turn in places:
                next(one)
            else:
                end = next(ends)
                while next(two) != end:
                    pass
        assert sorted(map(tuple, store.read(spark, "statements_history").collect())) == want_statements, places
        assert sorted(map(tuple, store.read(spark, "users_history").collect()), key=repr) == want_users, places
        assert store.read(spark, "sessions_history").groupBy("sessionid").count().where("count > 1").count() == 0
        if places in ((0, 1, 2), (0, 2, 4)):
            assert {r.job for r in store.run_log(spark).collect()} == {"capture_statements", "capture_sessions", "sync_users"}
    for df in (src, ses, usr, *hist.values()):
        df.unpersist()


def test_user_spans_over_three_nights(spark, store):
    """A user is renamed, then recreated: three spans, the last one open."""
    def night(ts, *people):
        rows = [(i, n, None, "f", "f", "t", -1) for i, n in people]
        jobs.sync_users(spark, store, spark.createDataFrame(rows, fx.users_src(spark, SF_SMALL).schema), ts)

    store.seed(spark, "users_history", fx.users_history(spark, SF_SMALL).limit(0))
    night("2024-01-01 01:00:00", (1, "ann"), (2, "bob"))
    night("2024-01-02 01:00:00", (1, "anna"), (2, "bob"))
    night("2024-01-03 01:00:00", (9, "anna"), (2, "bob"))
    got = {(r.username, r.userid, r.valid_from.day, r.valid_to and r.valid_to.day) for r in store.read(spark, "user_spans").collect()}
    assert got == {("ann", 1, 1, 2), ("anna", 1, 2, 3), ("anna", 9, 3, None), ("bob", 2, 1, None)}


def test_reconcile_brings_late_statements(spark, store):
    seed(spark, store, "statements_history", fx.statements_history_with_gaps(spark, SF_SMALL))
    src = fx.statements_src(spark, SF_SMALL)
    first = jobs.reconcile_statements(spark, store, src, fx.RUN_TS).first()
    assert first.inserted == first.extracted > 0 and first.updated == 0
    assert jobs.reconcile_statements(spark, store, src, fx.RUN_TS).first().extracted == 0  # once
    jobs.capture_statements(spark, store, src, fx.RUN_TS)
    want = capture.merge_upsert(fx.statements_history(spark, SF_SMALL), sc.staged_statements(spark, SF_SMALL), "statementid")
    assert same(store.read(spark, "statements_history"), want)


def test_two_null_usernames_do_not_fail_a_sync(spark, store):
    seed(spark, store, "users_history", fx.users_history(spark, SF_SMALL))
    seed(spark, store, "sessions_new", sc.staged_sessions(spark, SF_SMALL))
    extra = spark.createDataFrame([(1, None, None, "f", "f", "t", -1), (2, None, None, "f", "f", "t", -1)], fx.users_src(spark, SF_SMALL).schema)
    jobs.sync_users(spark, store, fx.users_src(spark, SF_SMALL).union(extra), fx.RUN_TS)
    assert store.read(spark, "users_history").where("username is null").count() == 2


def test_missed_rows_put_a_bloom_filter_on_a_shuffled_history(spark):
    """Beyond the broadcast budget Spark filters the history's scan itself."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
            "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g"}
    before = {k: spark.conf.get(k, None) for k in conf}
    real = capture.max_broadcast_rows
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        capture.max_broadcast_rows = lambda df: 0
        path = f"{default_root(spark, uuid.uuid4().hex)}"
        fx.statements_src(spark, SF_SMALL).write.parquet(f"{path}/src")
        fx.statements_history_with_gaps(spark, SF_SMALL).write.parquet(f"{path}/hist")
        src, hist = spark.read.parquet(f"{path}/src"), spark.read.parquet(f"{path}/hist")
        got = capture.missed_rows(src.where("retrynum = 1"), hist, "statementid", "endtime", "2024-01-14 00:00:00")
        assert "bloom" in got._jdf.queryExecution().optimizedPlan().toString().lower()
        want = src.where("retrynum = 1 and endtime <= timestamp_ntz'2024-01-14' and statementid % 13 = 5")
        assert sorted(r.statementid for r in got.collect()) == sorted(r.statementid for r in want.collect())
    finally:
        capture.max_broadcast_rows = real
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
