"""The nightly jobs as Spark jobs over ``Tables``.

B1 ``capture_statements``  watermark -> extract window -> stage -> merge by statementid
B2 ``capture_sessions``    watermark -> extract window -> stage -> merge by sessionid
B3 ``sync_users``          stage users -> five user steps fused -> replace; user spans
B4 ``capture_sessions_users``  B2 then B3

Each job takes the run time explicitly (no hidden clock), stages its
extract as a written table (one snapshot for counting and merging, and a
lineage cut), stages the next content of the partitions it touches and
publishes each table by dynamic partition overwrite. A job is a sequence of
steps (the generators ``*_steps``); jobs on different tables may overlap at
any step, and a run that died is finished by the next one on its table.
Returns the run metrics as a DataFrame (job, step, extracted, inserted,
updated), also kept in the run log.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import capture, spans, users, workload
from ..schemas import LAYOUT
from ..sinks.tables import RunLog, Tables, as_time

METRICS_SCHEMA = ("job string, step string, run_ts timestamp_ntz, low timestamp_ntz, high timestamp_ntz, "
                  "extracted long, inserted long, updated long")
FLAGS = {"update_changed": "_upd", "insert_new": "_ins", "last_activity": "_act", "soft_delete": "_del", "clear_revoked": "_clr"}


def _second(value: dt.datetime) -> dt.datetime:
    return value.replace(microsecond=0)


def _metrics(spark: SparkSession, logs: list[RunLog]) -> DataFrame:
    rows = [(r.job, r.step, r.run_ts, r.low, r.high, r.extracted, r.inserted, r.updated) for r in logs]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def drain(steps: Iterator[str]):
    """Run all steps of a job; its result."""
    while True:
        try:
            next(steps)
        except StopIteration as done:
            return done.value


def _merge_steps(spark: SparkSession, tables: Tables, job: str, step: str, run_ts, history: str, staging: str, wanted: DataFrame,
                 low=None, high=None) -> Iterator[str]:
    """Stage ``wanted``, merge it into ``history`` by its key and publish."""
    new = tables.replace_staging(spark, staging, wanted)
    yield "extracted"
    staged = tables.stage_merge(spark, history, new, job)
    yield "merged"
    entry = RunLog(job, step, as_time(run_ts), low, high, **staged.counts)
    tables.publish(spark, staged, [entry])
    yield "published"
    return entry


def capture_steps(spark: SparkSession, tables: Tables, job: str, source, run_ts, history: str, staging: str, extract, *,
                  dedupe_by: str | None = None) -> Iterator[str]:
    """One capture: watermark from the history, open window up to the run time
    cut to seconds, stage, merge, publish. ``source`` is a DataFrame or a
    callable ``(low, high) -> DataFrame``."""
    tables.recover(spark, history)
    low, high = tables.watermark(spark, history, run_ts), _second(as_time(run_ts))
    # a source may be built for the window (e.g. a parallel JDBC read of just
    # these rows); the extract's filter then repeats the window exactly
    wanted = extract(source(low, high) if callable(source) else source, low, high)
    if dedupe_by:
        wanted = capture.latest_per_key(wanted, LAYOUT[history].key, dedupe_by)
    return (yield from _merge_steps(spark, tables, job, "merge", run_ts, history, staging, wanted, low, high))


def statements_steps(spark: SparkSession, tables: Tables, source, run_ts, *, keep_last_retry: bool = False) -> Iterator[str]:
    entry = yield from capture_steps(spark, tables, "capture_statements", source, run_ts, "statements_history", "statements_new",
                                     capture.extract_statements, dedupe_by="retrynum" if keep_last_retry else None)
    return _metrics(spark, [entry])


def sessions_steps(spark: SparkSession, tables: Tables, source, run_ts) -> Iterator[str]:
    return (yield from capture_steps(spark, tables, "capture_sessions", source, run_ts, "sessions_history", "sessions_new",
                                     capture.extract_sessions))


def users_steps(spark: SparkSession, tables: Tables, users_source: DataFrame, run_ts, *, require_users: bool = False,
                sessions_rows: int | None = None) -> Iterator[str]:
    tables.recover(spark, "users_history", "user_spans")
    staged = tables.replace_staging(spark, "users_new", capture.extract_users(users_source))
    n = staged.count()
    if require_users and n == 0:
        raise RuntimeError("sync_users: the source returned no users; refusing to mark every user deleted")
    # one aggregate: a username staged twice fails the run (the update
    # would pick an arbitrary row); the row count sizes the user side
    # null names never match a row, so they are no duplicates of each other
    per_name = staged.where(F.col("username").isNotNull()).groupBy("username").agg(F.count(F.lit(1)).alias("c"))
    dup = per_name.agg(F.max_by("username", "c").alias("name"), F.max("c").alias("top")).first()
    if dup.top is not None and dup.top > 1:
        raise RuntimeError(f"sync_users: username {dup.name!r} appears twice in the source")
    yield "extracted"
    history = tables.read(spark, "users_history")
    known = tables.read(spark, "user_spans")
    if not known.limit(1).count():
        known = spans.spans_of(history)
    moved = tables.stage_replacement(spark, "user_spans", spans.advance_spans(known, staged, run_ts), "sync_users")
    yield "spans merged"
    flagged = users.sync_users_flagged(history, staged, tables.read(spark, "sessions_new"), run_ts, users_rows=n, sessions_rows=sessions_rows)
    synced = tables.stage_replacement(spark, "users_history", flagged, "sync_users")
    yield "users merged"
    flags = T.StructType([T.StructField(c, T.BooleanType()) for c in FLAGS.values()])
    got = tables.next_rows(spark, synced, flags).agg(*[F.count_if(F.col(c)).alias(c) for c in FLAGS.values()]).first()
    ts = as_time(run_ts)
    logs = [RunLog("sync_users", "extract_users", ts, extracted=n)]
    for step, flag in FLAGS.items():
        logs.append(RunLog("sync_users", step, ts, inserted=got[flag] if flag == "_ins" else 0, updated=0 if flag == "_ins" else got[flag]))
    tables.publish(spark, moved)
    yield "spans published"
    tables.publish(spark, synced, logs)
    yield "users published"
    return logs


def sessions_users_steps(spark: SparkSession, tables: Tables, sessions_source, users_source: DataFrame, run_ts, *,
                         require_users: bool = False) -> Iterator[str]:
    first = yield from sessions_steps(spark, tables, sessions_source, run_ts)
    logs = yield from users_steps(spark, tables, users_source, run_ts, require_users=require_users, sessions_rows=first.extracted)
    return _metrics(spark, [first, *logs])


def capture_statements(spark: SparkSession, tables: Tables, source, run_ts, *, keep_last_retry: bool = False) -> DataFrame:
    """B1: statements that ended since the last capture, upserted. A statement
    that was retried is several rows of one ``statementid``: an error, unless
    ``keep_last_retry`` asks for the one of the highest ``retrynum``."""
    return drain(statements_steps(spark, tables, source, run_ts, keep_last_retry=keep_last_retry))


def capture_sessions(spark: SparkSession, tables: Tables, source, run_ts) -> DataFrame:
    """B2: sessions that started since the last capture, upserted."""
    return _metrics(spark, [drain(sessions_steps(spark, tables, source, run_ts))])


def sync_users(spark: SparkSession, tables: Tables, users_source: DataFrame, run_ts, *, require_users: bool = False) -> DataFrame:
    """B3: refresh the users history and the user spans from the current user
    list and the sessions staged by the last session capture."""
    return _metrics(spark, drain(users_steps(spark, tables, users_source, run_ts, require_users=require_users)))


def capture_sessions_users(spark: SparkSession, tables: Tables, sessions_source, users_source: DataFrame, run_ts, *,
                           require_users: bool = False) -> DataFrame:
    """B4: sessions then users in one run, so the user rules see the sessions
    that this run staged."""
    return drain(sessions_users_steps(spark, tables, sessions_source, users_source, run_ts, require_users=require_users))


def reconcile_statements(spark: SparkSession, tables: Tables, source: DataFrame, run_ts) -> DataFrame:
    """Statements that the source still has at or below the watermark and that
    the history never got (they arrived late), merged into it."""
    tables.recover(spark, "statements_history")
    low = tables.watermark(spark, "statements_history", run_ts)
    late = capture.missed_rows(source, tables.read(spark, "statements_history"), "statementid", "endtime", low)
    wanted = capture.typed_statements(late)
    return _metrics(spark, [drain(_merge_steps(spark, tables, "reconcile_statements", "late", run_ts, "statements_history", "statements_late",
                                               wanted, high=low))])


def refresh_sketches(spark: SparkSession, tables: Tables, run_ts) -> DataFrame:
    """Duration sketches of the days that runs have touched since the last
    refresh (at first, of every day): only these days' statements are read, and
    only these days' sketches are replaced."""
    tables.recover(spark, "duration_sketches")
    runs, days = tables.unseen(spark, "statements_history", "refresh_sketches")
    first = not tables.read(spark, "duration_sketches").limit(1).count()
    statements = tables.read(spark, "statements_history", parts=None if first else days)
    owned = workload.owned_statements(statements, tables.read(spark, "sessions_history"))
    staged = tables.stage_replacement(spark, "duration_sketches", workload.duration_sketches(owned), "refresh_sketches", None if first else days)
    entry = RunLog("refresh_sketches", "sketches", as_time(run_ts), extracted=staged.rows)
    tables.publish(spark, staged, [entry])
    tables.mark_seen(spark, "refresh_sketches", runs)
    return _metrics(spark, [entry])


def edit_users(spark: SparkSession, tables: Tables, edits: DataFrame, run_ts) -> DataFrame:
    """Manual DBA edits applied to the stored users history. ``edits`` has
    username and any of the DBA columns."""
    tables.recover(spark, "users_history")
    n = edits.count()
    staged = tables.stage_replacement(spark, "users_history", users.set_user_attributes(tables.read(spark, "users_history"), edits), "edit_users")
    entry = RunLog("edit_users", "edits", as_time(run_ts), extracted=n)
    tables.publish(spark, staged, [entry])
    return _metrics(spark, [entry])


def compact(spark: SparkSession, tables: Tables, name: str, rows_per_file: int = 5_000_000, parts: list[str] | None = None) -> int:
    """W6: rewrite a table (or only ``parts`` of it) into about ``rows /
    rows_per_file`` files with the same rows, by Spark's partitioned writer.
    Each file holds a contiguous key range of few dates, and a dense date
    spreads over several files. Returns the number of files aimed at."""
    tables.recover(spark, name)
    layout = LAYOUT[name]
    rows = tables.read(spark, name, parts=parts)
    files = max(1, -(-rows.count() // rows_per_file))
    by = [F.to_date(F.col(layout.partition_source)), F.col(layout.key)] if layout.partition_by else [F.col(layout.key)]
    staged = tables.stage_replacement(spark, name, rows.repartitionByRange(files, *by), "compact", parts)
    tables.publish(spark, staged, [RunLog("compact", name, None, extracted=staged.rows)])
    return files
