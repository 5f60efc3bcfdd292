"""The registered queries: each reference report/job step applied to the
catalog and activity tables derived from the provided parquet tables.

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables: lazy for the operators, and for the nightly jobs the published
table after the job has run. Fixed times of the scenario are in
``sysledger.fixtures``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.expr import format_second, parse_second, to_bool
from ..operators import capture, intervals, listings, reports, sizing, spans, users, workload
from ..schemas import SESSIONS, SESSIONS_PRE_620, align_schema
from ..session import ensure_checkpoint_dir
from ..sinks.export import export_text, read_export
from ..sinks.tables import Tables, default_root
from ..sources.catalog import read_mixed
from ..sources.relstats import relation_stats
from . import jobs

# --- listings -------------------------------------------------------------


def q_list_schemas(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_schemas(fx.schemas(spark, sf))


def q_list_tables(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_tables(fx.tables(spark, sf), fx.schemas(spark, sf))


def q_list_views(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_views(fx.views(spark, sf), fx.schemas(spark, sf))


def q_list_functions(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_functions(fx.functions(spark, sf), fx.schemas(spark, sf))


def q_list_sessions_history(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_sessions_history(fx.sessions_history(spark, sf))


def q_list_sessions_since(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_sessions_history(merged_sessions(spark, sf), since=fx.SINCE)


def q_list_statements_history(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_statements_history(fx.statements_history(spark, sf))


def q_list_statements_since(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_statements_history(merged_statements(spark, sf), since=fx.SINCE)


def q_list_users_history(spark: SparkSession, sf: str) -> DataFrame:
    return listings.list_users_history(fx.users_history(spark, sf), ordered=True)


# --- sizing ---------------------------------------------------------------


def q_table_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return sizing.table_sizes(fx.relstats(spark, sf))


# Relations measured by the size estimator: (table, schema name).
MEASURED_RELATIONS = [("documents", "corpus"), ("pages", "web"), ("conversations", "chat"), ("embeddings", "vectors")]


def q_relation_stats(spark: SparkSession, sf: str) -> DataFrame:
    out = None
    for name, schema in MEASURED_RELATIONS:
        one = relation_stats(fx.table(spark, sf, name), owner="dba", database="db_0", schema=schema, relation=name)
        out = one if out is None else out.unionByName(one)
    return out


# --- statement and session capture ---------------------------------------


def staged_statements(spark: SparkSession, sf: str) -> DataFrame:
    """This run's statements: ended after the history's watermark and
    before the run time (cut to seconds)."""
    low = capture.watermark_value(fx.statements_history(spark, sf), "endtime")
    return capture.extract_statements(fx.statements_src(spark, sf), low, capture.upper_bound(fx.RUN_TS))


def merged_statements(spark: SparkSession, sf: str) -> DataFrame:
    return capture.merge_upsert(fx.statements_history(spark, sf), staged_statements(spark, sf), "statementid")


def staged_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """This run's sessions: started after the history's watermark."""
    low = capture.watermark_value(fx.sessions_history(spark, sf), "starttime")
    return capture.extract_sessions(fx.sessions_src(spark, sf), low, capture.upper_bound(fx.RUN_TS))


def overlap_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """A window reaching into the captured history, so the merge updates."""
    return capture.extract_sessions(fx.sessions_src(spark, sf), fx.MERGE_WINDOW_LOW, capture.upper_bound(fx.RUN_TS))


def merged_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return capture.merge_upsert(align_schema(fx.sessions_history(spark, sf), SESSIONS), overlap_sessions(spark, sf),
                                "sessionid")


def user_rule_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions staged by the run that feeds the user rules."""
    return capture.extract_sessions(fx.sessions_src(spark, sf), fx.HISTORY_CUT, capture.upper_bound(fx.RUN_TS))


def _watermark_row(history: DataFrame, ts_col: str) -> DataFrame:
    return capture.watermark(history, ts_col).select("watermark", capture.upper_bound(fx.RUN_TS).alias("upper_bound"))


def q_watermark_statements(spark: SparkSession, sf: str) -> DataFrame:
    return _watermark_row(fx.statements_history(spark, sf), "endtime")


def q_watermark_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return _watermark_row(fx.sessions_history(spark, sf), "starttime")


def q_watermark_empty(spark: SparkSession, sf: str) -> DataFrame:
    """First run: no statement captured before 2000, so the default."""
    none_yet = fx.statements_src(spark, sf).where(F.col("endtime") < F.lit("2000-01-01").cast("timestamp_ntz"))
    return _watermark_row(none_yet, "endtime")


def q_extract_statements(spark: SparkSession, sf: str) -> DataFrame:
    return staged_statements(spark, sf)


def q_extract_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return staged_sessions(spark, sf)


def q_extract_users(spark: SparkSession, sf: str) -> DataFrame:
    return capture.extract_users(fx.users_src(spark, sf))


def q_extract_counts(spark: SparkSession, sf: str) -> DataFrame:
    parts = [
        ("statements", staged_statements(spark, sf)),
        ("sessions", staged_sessions(spark, sf)),
        ("users", capture.extract_users(fx.users_src(spark, sf))),
    ]
    out = None
    for name, df in parts:
        one = capture.extract_count(df).select(F.lit(name).alias("source"), "extracted")
        out = one if out is None else out.unionByName(one)
    return out


def q_merge_statements(spark: SparkSession, sf: str) -> DataFrame:
    return merged_statements(spark, sf)


def q_merge_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return merged_sessions(spark, sf)


def q_merge_counts(spark: SparkSession, sf: str) -> DataFrame:
    st = capture.merge_counts(fx.statements_history(spark, sf), staged_statements(spark, sf), "statementid")
    se = capture.merge_counts(fx.sessions_history(spark, sf), overlap_sessions(spark, sf), "sessionid")
    return st.select(F.lit("statements").alias("target"), "*").unionByName(
        se.select(F.lit("sessions").alias("target"), "*"))


# --- users ----------------------------------------------------------------


def q_users_update_changed(spark: SparkSession, sf: str) -> DataFrame:
    return users.users_update_changed(fx.users_history(spark, sf), fx.staged_users(spark, sf))


def q_users_insert_new(spark: SparkSession, sf: str) -> DataFrame:
    return users.users_insert_new(fx.users_history(spark, sf), fx.staged_users(spark, sf), fx.RUN_TS)


def q_users_last_activity(spark: SparkSession, sf: str) -> DataFrame:
    return users.users_last_activity(fx.users_history(spark, sf), user_rule_sessions(spark, sf), fx.RUN_TS)


def q_users_soft_delete(spark: SparkSession, sf: str) -> DataFrame:
    return users.users_soft_delete(fx.users_history(spark, sf), fx.staged_users(spark, sf), fx.RUN_TS)


def q_users_clear_revoked(spark: SparkSession, sf: str) -> DataFrame:
    return users.users_clear_revoked(fx.users_history(spark, sf), user_rule_sessions(spark, sf), fx.RUN_TS)


def synced_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return users.sync_users_flagged(fx.users_history(spark, sf), fx.staged_users(spark, sf),
                                    user_rule_sessions(spark, sf), fx.RUN_TS)


def q_sync_users(spark: SparkSession, sf: str) -> DataFrame:
    return synced_flagged(spark, sf).select(*users.HIST_COLUMNS)


def q_sync_user_counts(spark: SparkSession, sf: str) -> DataFrame:
    return users.sync_user_counts(synced_flagged(spark, sf))


def user_edits(spark: SparkSession, sf: str) -> DataFrame:
    """DBA edits: building-segment customers get a display name with their
    segment and are exempted from inactivity rules."""
    cust = fx.table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return cust.select(
        F.concat(F.lit("user_"), F.col("c_custkey").cast("string")).alias("username"),
        F.concat(F.col("c_name"), F.lit(" ("), F.col("c_mktsegment"), F.lit(")")).alias("full_username"),
        F.lit(True).alias("exempt_activity_flag"),
        F.when(F.col("c_nationkey") < 12, F.lit(fx.RUN_TS).cast("timestamp_ntz")).alias("connect_revoked_time"),
        (F.col("c_custkey") + 5000000).alias("security_unique_id"),
        F.concat(F.lit("staff"), F.col("c_custkey").cast("string"), F.lit("@example.org")).alias("email_address"),
    )


def q_set_user_attributes(spark: SparkSession, sf: str) -> DataFrame:
    return users.set_user_attributes(fx.users_history(spark, sf), user_edits(spark, sf))


# --- schema upgrade -------------------------------------------------------


def q_align_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Session history written before the 6.20 columns, read as current."""
    old = fx.sessions_history(spark, sf).select(*SESSIONS_PRE_620.fieldNames())
    return align_schema(old, SESSIONS)


# --- documented uses ------------------------------------------------------


def all_statements(spark: SparkSession, sf: str) -> DataFrame:
    src = fx.statements_src(spark, sf)
    return src.withColumn("iscancelable", to_bool("iscancelable"))


def all_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return fx.sessions_src(spark, sf).withColumn("status", F.lit(capture.SESSION_STATUS))


def q_statement_attribution(spark: SparkSession, sf: str) -> DataFrame:
    return reports.statement_attribution(all_statements(spark, sf), all_sessions(spark, sf), fx.users_history(spark, sf))


LONG_RUNNING_SECONDS = 300


def q_long_running(spark: SparkSession, sf: str) -> DataFrame:
    return reports.long_running(all_statements(spark, sf), LONG_RUNNING_SECONDS)


INACTIVE_DAYS = 1


def q_inactive_users(spark: SparkSession, sf: str) -> DataFrame:
    return reports.inactive_users(q_sync_users(spark, sf), fx.RUN_TS, INACTIVE_DAYS)


GAP_SECONDS = 3600


def q_capture_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return reports.capture_gaps(all_sessions(spark, sf), "starttime", GAP_SECONDS)


SUSPECT_PATTERNS = [r'"k": *[0-9]*7[^0-9]', r"drop +table"]


def q_statements_matching(spark: SparkSession, sf: str) -> DataFrame:
    """Statements whose text matches a pattern, with their user."""
    return reports.statements_matching(all_statements(spark, sf), all_sessions(spark, sf), fx.users_history(spark, sf), SUSPECT_PATTERNS)


def q_time_text(spark: SparkSession, sf: str) -> DataFrame:
    """Statement times as display text and back to whole seconds."""
    return fx.statements_src(spark, sf).select(
        "statementid", format_second("endtime").alias("shown"), parse_second(format_second("endtime")).alias("back"))


def q_relation_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The size report fed by the measured relations."""
    return sizing.table_sizes(q_relation_stats(spark, sf))


def q_attribution_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Each statement with the userid that its user's name had at its time."""
    return spans.attribute_as_of(all_statements(spark, sf), all_sessions(spark, sf), fx.user_spans(spark, sf))


def q_user_spans(spark: SparkSession, sf: str) -> DataFrame:
    """The spans of the history before the run, advanced by the run's list."""
    return spans.advance_spans(spans.spans_of(fx.users_history(spark, sf)), fx.staged_users(spark, sf), fx.RUN_TS)


def q_missed_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Statements that the history never got though their time has passed."""
    history = fx.statements_history_with_gaps(spark, sf)
    low = capture.watermark_value(history, "endtime")
    return capture.typed_statements(capture.missed_rows(fx.statements_src(spark, sf), history, "statementid", "endtime", low))


SESSION_GAP_SECONDS = 6 * 3600


def q_closed_sessions(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.closed_sessions(all_sessions(spark, sf), all_statements(spark, sf), fx.RUN_TS, SESSION_GAP_SECONDS)


def q_user_activity(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.user_activity(all_sessions(spark, sf), fx.RUN_TS)


INACTIVE_SECONDS = 12 * 3600


def q_inactive_stretches(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.inactive_stretches(all_sessions(spark, sf), fx.users_history(spark, sf), fx.RUN_TS, INACTIVE_SECONDS)


LONG_QUANTILE = 0.95
LONG_LEAST_STATEMENTS = 20


def q_unusually_long(spark: SparkSession, sf: str) -> DataFrame:
    """Statements above the 95 % duration of their database and user."""
    owned = workload.owned_statements(all_statements(spark, sf), all_sessions(spark, sf))
    by = ["dbname", "username"]
    limits = workload.duration_thresholds(workload.duration_sketches(owned), by, LONG_QUANTILE)
    return workload.unusually_long(owned, limits, by, LONG_LEAST_STATEMENTS)


def q_pattern_matches(spark: SparkSession, sf: str) -> DataFrame:
    """Statements that match a table of patterns, one for each part."""
    return workload.match_patterns(fx.statements_sql(spark, sf), "statement", "statementid", fx.search_patterns(spark, sf))


SHAPES_SHOWN = 20


def q_statement_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """The shapes that used most time, by database and over all."""
    return workload.shape_report(workload.owned_statements(fx.statements_sql(spark, sf), all_sessions(spark, sf)), SHAPES_SHOWN)


# --- the nightly jobs over their tables ---------------------------------
#
# Each builder runs the job eagerly into fresh tables under the session's
# shared checkpoint folder (a scratch folder only when the session has
# none, as in tests), then returns the published table lazily.


def fresh_tables(spark: SparkSession) -> Tables:
    ensure_checkpoint_dir(spark)
    return Tables(default_root(spark, f"sysledger_runs/{uuid.uuid4().hex}"))


SEEDS = {"statements_history": fx.statements_history, "sessions_history": fx.sessions_history, "users_history": fx.users_history}


def _seeded(spark: SparkSession, sf: str, *names: str) -> Tables:
    """Tables holding the histories as captured up to the history cut."""
    tables = fresh_tables(spark)
    for name in names:
        tables.seed(spark, name, SEEDS[name](spark, sf))
    return tables


def _b1(spark: SparkSession, sf: str) -> tuple[Tables, DataFrame]:
    store = _seeded(spark, sf, "statements_history")
    return store, jobs.capture_statements(spark, store, fx.statements_src(spark, sf), fx.RUN_TS)


def _b4(spark: SparkSession, sf: str) -> tuple[Tables, DataFrame]:
    store = _seeded(spark, sf, "sessions_history", "users_history")
    return store, jobs.capture_sessions_users(spark, store, fx.sessions_src(spark, sf), fx.users_src(spark, sf), fx.RUN_TS)


def q_job_user_spans(spark: SparkSession, sf: str) -> DataFrame:
    """The user spans that the nightly run keeps."""
    return _b4(spark, sf)[0].read(spark, "user_spans")


def q_job_reconcile_statements(spark: SparkSession, sf: str) -> DataFrame:
    """Late statements merged into a history that never got them."""
    store = fresh_tables(spark)
    store.seed(spark, "statements_history", fx.statements_history_with_gaps(spark, sf))
    jobs.reconcile_statements(spark, store, fx.statements_src(spark, sf), fx.RUN_TS)
    return store.read(spark, "statements_history")


def q_job_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """Thresholds from stored sketches: a refresh over the histories before the
    run, the run, and a refresh of the days that it touched."""
    store = _seeded(spark, sf, "statements_history", "sessions_history")
    jobs.refresh_sketches(spark, store, fx.HISTORY_CUT)
    jobs.capture_sessions(spark, store, fx.sessions_src(spark, sf), fx.RUN_TS)
    jobs.capture_statements(spark, store, fx.statements_src(spark, sf), fx.RUN_TS)
    jobs.refresh_sketches(spark, store, fx.RUN_TS)
    return workload.duration_thresholds(store.read(spark, "duration_sketches"), ["dbname", "username"], LONG_QUANTILE)


def q_mixed_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Session history in files of two versions: the files of three sessions
    out of four lack the 6.20 columns. Every row is read."""
    path = f"{fresh_tables(spark).root}/mixed_sessions"
    rows = align_schema(fx.sessions_history(spark, sf), SESSIONS).withColumn("parentsessionid", F.col("sessionid") - 4)
    turn = F.floor(F.col("sessionid") / 4) % 4
    rows.where(turn < 3).select(*SESSIONS_PRE_620.fieldNames()).write.mode("append").parquet(path)
    rows.where(turn == 3).write.mode("append").parquet(path)
    return read_mixed(spark, path, SESSIONS)


def q_job_capture_statements(spark: SparkSession, sf: str) -> DataFrame:
    store, _ = _b1(spark, sf)
    return store.read(spark, "statements_history")


def q_job_capture_sessions(spark: SparkSession, sf: str) -> DataFrame:
    store = _seeded(spark, sf, "sessions_history")
    jobs.capture_sessions(spark, store, fx.sessions_src(spark, sf), fx.RUN_TS)
    return store.read(spark, "sessions_history")


def q_job_list_sessions_since(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions listing with a reach-back bound over the captured history:
    only the date partitions from the bound on are read."""
    store = _seeded(spark, sf, "sessions_history")
    jobs.capture_sessions(spark, store, fx.sessions_src(spark, sf), fx.RUN_TS)
    hist = store.read(spark, "sessions_history", since=fx.SINCE, since_col="starttime")
    return listings.list_sessions_history(hist, since=fx.SINCE)


def q_job_sync_users(spark: SparkSession, sf: str) -> DataFrame:
    store, _ = _b4(spark, sf)
    return store.read(spark, "users_history")


def q_job_sync_users_alone(spark: SparkSession, sf: str) -> DataFrame:
    """The user sync by itself, after a session capture of its own."""
    store = _seeded(spark, sf, "sessions_history", "users_history")
    jobs.capture_sessions(spark, store, fx.sessions_src(spark, sf), fx.RUN_TS)
    jobs.sync_users(spark, store, fx.users_src(spark, sf), fx.RUN_TS)
    return store.read(spark, "users_history")


def q_job_edit_users(spark: SparkSession, sf: str) -> DataFrame:
    """DBA edits applied to the stored users history."""
    store = _seeded(spark, sf, "users_history")
    jobs.edit_users(spark, store, user_edits(spark, sf), fx.RUN_TS)
    return store.read(spark, "users_history")


def retried_statements(spark: SparkSession, sf: str) -> DataFrame:
    """The statements source with every third statement tried a second time."""
    src = fx.statements_src(spark, sf)
    again = src.where(F.col("retrynum") == 2).select(
        *[F.col("retrynum") + F.lit(1) if c == "retrynum" else F.concat("statement", F.lit(" -- again")) if c == "statement" else F.col(c)
          for c in src.columns]).toDF(*src.columns)
    return src.union(again)


def q_job_capture_retried(spark: SparkSession, sf: str) -> DataFrame:
    """The statement capture over a source with retries, the last one kept."""
    store = _seeded(spark, sf, "statements_history")
    jobs.capture_statements(spark, store, retried_statements(spark, sf), fx.RUN_TS, keep_last_retry=True)
    return store.read(spark, "statements_history")


def q_run_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Consecutive runs 72 hours apart or more, over the run log that a
    capture at each order date of a clerk's orders would have left."""
    runs = fx.table(spark, sf, "orders").select(
        F.concat(F.lit("capture_"), F.col("o_orderpriority")).alias("job"),
        F.timestamp_add("HOUR", F.col("o_orderkey") % 24, F.col("o_orderdate").cast("timestamp_ntz")).alias("run_ts"))
    return reports.run_gaps(runs).select("job", "gap_start", "gap_end", "gap_us")


def q_job_metrics(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["job", "step", "extracted", "inserted", "updated"]
    return _b1(spark, sf)[1].select(*cols).unionByName(_b4(spark, sf)[1].select(*cols))


def q_compact(spark: SparkSession, sf: str) -> DataFrame:
    store, _ = _b1(spark, sf)
    jobs.compact(spark, store, "statements_history")
    return store.read(spark, "statements_history")


def q_export_text(spark: SparkSession, sf: str) -> DataFrame:
    listing = q_list_tables(spark, sf)
    path = f"{fresh_tables(spark).root}/export/list_tables"
    export_text(listing, path)
    return read_export(spark, path, listing.schema)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
