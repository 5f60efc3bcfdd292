"""Command line: the listings, the size report and the nightly jobs.

    python -m sysledger list tables --catalog DIR --out PATH [--sep '|']
    python -m sysledger list sessions --store ROOT --out PATH [--since TS]
    python -m sysledger capture-statements --store ROOT --source SRC [--run-ts TS]
    python -m sysledger capture-sessions-users --store ROOT --sessions SRC --users SRC [--run-ts TS]
    python -m sysledger sync-users --store ROOT --users SRC [--require-users]
    python -m sysledger edit-users --store ROOT --edits SRC
    python -m sysledger reconcile-statements --store ROOT --source SRC
    python -m sysledger refresh-sketches --store ROOT
    python -m sysledger run-gaps --store ROOT --out PATH [--max-hours 72]
    python -m sysledger report REPORT --store ROOT --out PATH [--patterns SRC] [--quantile 0.95] [--hours N] [--top N]
    python -m sysledger compact --store ROOT --table NAME [--parts D1,D2]

A source SRC is a parquet path, a table name, or ``jdbc:...`` with
``--jdbc-table`` (the capture window then reaches the database, and every
table is read by several queries of about as many rows each). Database credentials come only from ``--jdbc-properties FILE``
(key=value lines). Catalog tables are read from ``--catalog DIR``
(parquet named schemas, tables, views, functions, relstats) or over JDBC
from the source database's system schema. The run time defaults to the
current UTC time, taken once.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession

from .operators import intervals, listings, reports, sizing, spans, workload
from .plans import jobs
from .sinks.export import export_text
from .sinks.tables import Tables, default_root
from .sources.catalog import read_catalog
from .sources.remote import column_name, read_remote, read_split, windowed_source

# System tables of the source database (fixed names).
SYSTEM_SCHEMA_NAME = "nc_system"
SYSTEM_TABLES = {
    "schemas": "nc_all_schemas",
    "tables": "nc_all_tables",
    "views": "nc_all_views",
    "functions": "nc_all_sqlmr_funcs",
    "statements": "nc_all_statements",
    "sessions": "nc_all_sessions",
    "users": "nc_all_users",
    "relstats": "nc_relationstats",
}
# Key that a table without a capture window is split on.
SPLIT_COLUMNS = {"nc_all_schemas": "schemaid", "nc_all_tables": "tableid", "nc_all_views": "viewid", "nc_all_sqlmr_funcs": "funcid",
                 "nc_all_statements": "statementid", "nc_all_sessions": "sessionid", "nc_all_users": "userid"}


def _props(path: str | None) -> dict[str, str]:
    if not path:
        return {}
    out = {}
    with open(path) as fh:
        for line in fh:
            line = line.strip()
            if line and not line.startswith("#") and "=" in line:
                k, v = line.split("=", 1)
                out[k.strip()] = v.strip()
    return out


def _jdbc(spark: SparkSession, args, url: str, table: str, system_table: str) -> DataFrame:
    """A whole table of the database."""
    query, props, column = f"SELECT * FROM {table}", _props(args.jdbc_properties), SPLIT_COLUMNS.get(system_table)
    if column:
        column = column_name(spark, url, table, column, props)
        return read_split(spark, url, query, column, args.jdbc_num_partitions, properties=props)
    df = read_remote(spark, url, query, properties=props)
    return df.toDF(*[c.lower() for c in df.columns])


def _source(spark: SparkSession, args, src: str, system_table: str, ts_col: str | None = None):
    if src.startswith("jdbc:"):
        table = args.jdbc_table or f"{SYSTEM_SCHEMA_NAME}.{system_table}"
        if ts_col:  # read only the capture window
            return windowed_source(spark, src, table, ts_col, properties=_props(args.jdbc_properties),
                                   partition_column=args.jdbc_partition_column, num_partitions=args.jdbc_num_partitions)
        return _jdbc(spark, args, src, table, system_table)
    return read_catalog(spark, system_table, src)


def _catalog(spark: SparkSession, args, name: str) -> DataFrame:
    if args.catalog.startswith("jdbc:"):
        # relation sizes are the result of a table function: name a table or a query of them
        table = args.jdbc_table if name == "relstats" and args.jdbc_table else f"{args.catalog_schema}.{SYSTEM_TABLES[name]}"
        return _jdbc(spark, args, args.catalog, table, SYSTEM_TABLES[name])
    return read_catalog(spark, name, f"{args.catalog.rstrip('/')}/{name}")


def _run_ts(args) -> dt.datetime:
    if args.run_ts:
        return dt.datetime.fromisoformat(args.run_ts)
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _store(spark: SparkSession, args) -> Tables:
    return Tables(args.store or default_root(spark))


def listing(spark: SparkSession, args) -> DataFrame:
    what = args.what
    if what == "schemas":
        return listings.list_schemas(_catalog(spark, args, "schemas"))
    if what in ("tables", "views", "functions"):
        fn = {"tables": listings.list_tables, "views": listings.list_views, "functions": listings.list_functions}[what]
        return fn(_catalog(spark, args, what), _catalog(spark, args, "schemas"))
    if what == "sizes":
        return sizing.table_sizes(_catalog(spark, args, "relstats"))
    store = _store(spark, args)
    if what == "sessions":
        hist = store.read(spark, "sessions_history", since=args.since, since_col="starttime")
        return listings.list_sessions_history(hist, since=args.since)
    if what == "statements":
        hist = store.read(spark, "statements_history", since=args.since, since_col="starttime")
        return listings.list_statements_history(hist, since=args.since)
    return listings.list_users_history(store.read(spark, "users_history"), ordered=True)


REPORTS = ["attribution", "long-statements", "patterns", "shapes", "sessions", "activity", "inactive"]


def report(spark: SparkSession, args) -> DataFrame:
    """The documented uses over the stored histories, as of the run time."""
    store, now = _store(spark, args), _run_ts(args)
    statements, sessions = store.read(spark, "statements_history"), store.read(spark, "sessions_history")
    what = args.report
    if what == "attribution":
        return spans.attribute_as_of(statements, sessions, store.read(spark, "user_spans"))
    if what == "long-statements":
        limits = workload.duration_thresholds(store.read(spark, "duration_sketches"), ["dbname", "username"], args.quantile)
        return workload.unusually_long(workload.owned_statements(statements, sessions), limits, ["dbname", "username"], args.min_statements)
    if what == "patterns":
        hits = workload.match_patterns(statements, "statement", "statementid", read_catalog(spark, "patterns", args.patterns))
        return hits.join(spans.attribute_as_of(statements.join(hits.select("statementid").distinct(), "statementid", "left_semi"), sessions,
                                               store.read(spark, "user_spans")), "statementid")
    if what == "shapes":
        return workload.shape_report(workload.owned_statements(statements, sessions), args.top)
    if what == "sessions":
        return intervals.closed_sessions(sessions, statements, now, args.hours * 3600)
    if what == "activity":
        return intervals.user_activity(sessions, now)
    return intervals.inactive_stretches(sessions, store.read(spark, "users_history"), now, args.hours * 3600)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="sysledger")
    sub = p.add_subparsers(dest="cmd", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--store", help="root of the staging and history tables (default: under spark.checkpoint.dir)")
    common.add_argument("--jdbc-table")
    common.add_argument("--jdbc-properties", help="file of key=value JDBC options (user, password, driver, ...)")
    common.add_argument("--jdbc-partition-column", help="key or time column to split a windowed JDBC extract on (default: the window's time)")
    common.add_argument("--jdbc-num-partitions", type=int, default=8)
    common.add_argument("--run-ts", help="run time, YYYY-MM-DD HH:MM:SS[.ffffff] (default: now, UTC)")

    ls = sub.add_parser("list", parents=[common])
    ls.add_argument("what", choices=["schemas", "tables", "views", "functions", "sizes", "sessions", "statements", "users"])
    ls.add_argument("--catalog", default="", help="parquet dir of catalog tables, or a jdbc: URL")
    ls.add_argument("--catalog-schema", default=SYSTEM_SCHEMA_NAME, help="database schema of the catalog tables (JDBC)")
    ls.add_argument("--out", required=True)
    ls.add_argument("--sep", default="|")
    ls.add_argument("--since", help="reach-back bound for history listings")

    cs = sub.add_parser("capture-statements", parents=[common])
    cs.add_argument("--source", required=True)
    cs.add_argument("--keep-last-retry", action="store_true", help="of a retried statement keep the last try")
    rs = sub.add_parser("reconcile-statements", parents=[common])
    rs.add_argument("--source", required=True)
    su = sub.add_parser("sync-users", parents=[common])
    su.add_argument("--users", required=True)
    su.add_argument("--require-users", action="store_true")
    eu = sub.add_parser("edit-users", parents=[common])
    eu.add_argument("--edits", required=True, help="table of username and the DBA columns to set")
    rg = sub.add_parser("run-gaps", parents=[common])
    rg.add_argument("--out", required=True)
    rg.add_argument("--sep", default="|")
    rg.add_argument("--max-hours", type=int, default=reports.MAX_RUN_SPACING_HOURS)
    cse = sub.add_parser("capture-sessions", parents=[common])
    cse.add_argument("--source", required=True)
    csu = sub.add_parser("capture-sessions-users", parents=[common])
    csu.add_argument("--sessions", required=True)
    csu.add_argument("--users", required=True)
    csu.add_argument("--require-users", action="store_true")
    sub.add_parser("refresh-sketches", parents=[common])
    rp = sub.add_parser("report", parents=[common])
    rp.add_argument("report", choices=REPORTS)
    rp.add_argument("--out", required=True)
    rp.add_argument("--sep", default="|")
    rp.add_argument("--patterns", help="table of pattern_id and pattern (LIKE), for the report of that name")
    rp.add_argument("--quantile", type=float, default=0.95, help="long-statements: share of a group's statements that are not long")
    rp.add_argument("--min-statements", type=int, default=20, help="long-statements: smaller groups have no threshold")
    rp.add_argument("--hours", type=int, default=24, help="sessions: idle time that ends one; inactive: least stretch")
    rp.add_argument("--top", type=int, default=20, help="shapes: places shown of each database")
    cp = sub.add_parser("compact", parents=[common])
    cp.add_argument("--table", required=True)
    cp.add_argument("--parts", help="comma-separated partition dates (default: all)")
    cp.add_argument("--rows-per-file", type=int, default=5_000_000)

    args = p.parse_args(argv)
    if spark is None:
        from .session import get_session

        spark = get_session()
    if args.cmd == "list":
        export_text(listing(spark, args), args.out, args.sep)
        return 0
    if args.cmd == "report":
        if args.report == "patterns" and not args.patterns:
            p.error("the report of patterns needs --patterns")
        export_text(report(spark, args), args.out, args.sep)
        return 0
    if args.cmd == "compact":
        parts = args.parts.split(",") if args.parts else None
        print(json.dumps({"files": jobs.compact(spark, _store(spark, args), args.table, args.rows_per_file, parts)}))
        return 0
    if args.cmd == "run-gaps":
        log = _store(spark, args).run_log(spark).where("run_ts is not null").select("job", "run_ts").distinct()
        export_text(reports.run_gaps(log, args.max_hours), args.out, args.sep)
        return 0
    run_ts = _run_ts(args)
    store = _store(spark, args)
    if args.cmd == "capture-statements":
        metrics = jobs.capture_statements(spark, store, _source(spark, args, args.source, "nc_all_statements", "endtime"),
                                          run_ts, keep_last_retry=args.keep_last_retry)
    elif args.cmd == "reconcile-statements":
        metrics = jobs.reconcile_statements(spark, store, _source(spark, args, args.source, "nc_all_statements"), run_ts)
    elif args.cmd == "sync-users":
        metrics = jobs.sync_users(spark, store, _source(spark, args, args.users, "nc_all_users"), run_ts, require_users=args.require_users)
    elif args.cmd == "refresh-sketches":
        metrics = jobs.refresh_sketches(spark, store, run_ts)
    elif args.cmd == "edit-users":
        metrics = jobs.edit_users(spark, store, read_catalog(spark, "user_edits", args.edits), run_ts)
    elif args.cmd == "capture-sessions":
        metrics = jobs.capture_sessions(spark, store, _source(spark, args, args.source, "nc_all_sessions", "starttime"),
                                        run_ts)
    else:
        metrics = jobs.capture_sessions_users(
            spark, store, _source(spark, args, args.sessions, "nc_all_sessions", "starttime"),
            _source(spark, args, args.users, "nc_all_users"), run_ts, require_users=args.require_users)
    for row in metrics.collect():  # one row per job step
        print(json.dumps({k: (v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v) for k, v in row.asDict().items()}))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
