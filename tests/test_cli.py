"""Command line: listing export from a parquet catalog, and a statement
capture whose source is a JDBC table (in-process Derby, no server)."""

from __future__ import annotations

import uuid

from conftest import SF_SMALL

from sysledger import fixtures as fx
from sysledger.__main__ import main
from sysledger.operators import capture
from sysledger.plans import scenarios as sc
from sysledger.session import checkpoint_dir
from sysledger.sinks.export import read_export
from sysledger.sinks.tables import Tables


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_list_tables_to_text(spark):
    root = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex[:8]}"
    fx.schemas(spark, SF_SMALL).write.parquet(f"{root}/catalog/schemas")
    fx.tables(spark, SF_SMALL).write.parquet(f"{root}/catalog/tables")
    assert main(["list", "tables", "--catalog", f"{root}/catalog", "--out", f"{root}/out"], spark=spark) == 0
    want = sc.q_list_tables(spark, SF_SMALL)
    assert same(read_export(spark, f"{root}/out", want.schema), want)


def test_capture_from_jdbc_source_pushes_the_window(spark, tmp_path):
    root = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex[:8]}"
    url = f"jdbc:derby:memory:cli{uuid.uuid4().hex[:8]};create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    fx.statements_src(spark, SF_SMALL).write.format("jdbc").option("url", url).option("dbtable", "NC_ALL_STATEMENTS") \
        .options(**driver).save()
    props = tmp_path / "db.properties"
    props.write_text("driver=org.apache.derby.jdbc.EmbeddedDriver\n")
    args = ["capture-statements", "--store", f"{root}/store", "--source", url, "--jdbc-table", "NC_ALL_STATEMENTS",
            "--jdbc-properties", str(props), "--run-ts", fx.RUN_TS]
    assert main(args, spark=spark) == 0
    store = Tables(f"{root}/store")
    got = store.read(spark, "statements_history")
    want = capture.extract_statements(fx.statements_src(spark, SF_SMALL), "2000-01-01 00:00:00", "2024-01-25 00:00:00")
    assert same(got, want)
    # the window reaches the database as pushed filters
    src = spark.read.format("jdbc").option("url", url).option("dbtable", "NC_ALL_STATEMENTS").options(**driver).load()
    plan = capture.extract_window(src, "endtime", "2024-01-01 00:00:00", "2024-01-02 00:00:00") \
        ._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(endtime), *GreaterThan(endtime" in plan


def test_capture_reads_the_window_as_parallel_range_queries(spark, tmp_path):
    root = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex[:8]}"
    url = f"jdbc:derby:memory:cli{uuid.uuid4().hex[:8]};create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    src = fx.statements_src(spark, SF_SMALL)
    src.toDF(*[c.upper() for c in src.columns]).write.format("jdbc").option("url", url) \
        .option("dbtable", "NC_ALL_STATEMENTS").options(**driver).save()
    props = tmp_path / "db.properties"
    props.write_text("driver=org.apache.derby.jdbc.EmbeddedDriver\n")
    args = ["capture-statements", "--store", f"{root}/store", "--source", url, "--jdbc-table", "NC_ALL_STATEMENTS",
            "--jdbc-properties", str(props), "--jdbc-partition-column", "STATEMENTID", "--jdbc-num-partitions", "4",
            "--run-ts", fx.RUN_TS]
    assert main(args, spark=spark) == 0
    got = Tables(f"{root}/store").read(spark, "statements_history")
    want = capture.extract_statements(src, "2000-01-01 00:00:00", "2024-01-25 00:00:00")
    assert same(got, want)


def test_history_listings_and_compaction_from_the_store(spark, tmp_path):
    root = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex[:8]}"
    fx.sessions_src(spark, SF_SMALL).write.parquet(f"{root}/src/sessions")
    fx.users_src(spark, SF_SMALL).write.parquet(f"{root}/src/users")
    store_root = f"{root}/store"
    args = ["capture-sessions-users", "--store", store_root, "--sessions", f"{root}/src/sessions",
            "--users", f"{root}/src/users", "--run-ts", fx.RUN_TS]
    assert main(args, spark=spark) == 0
    store = Tables(store_root)
    sessions = store.read(spark, "sessions_history")
    assert main(["list", "sessions", "--store", store_root, "--since", fx.SINCE, "--out", f"{root}/ls"], spark=spark) == 0
    from sysledger.operators import listings

    want = listings.list_sessions_history(sessions, since=fx.SINCE)
    assert same(read_export(spark, f"{root}/ls", want.schema), want)
    assert main(["list", "users", "--store", store_root, "--out", f"{root}/lu"], spark=spark) == 0
    users = listings.list_users_history(store.read(spark, "users_history"))
    assert same(read_export(spark, f"{root}/lu", users.schema), users)
    before = set(sessions.inputFiles())
    assert main(["compact", "--store", store_root, "--table", "sessions_history", "--rows-per-file", "100"], spark=spark) == 0
    assert not before & set(store.read(spark, "sessions_history").inputFiles())
    assert same(store.read(spark, "sessions_history"), fx.sessions_src(spark, SF_SMALL).where("starttime < timestamp_ntz'2024-01-25'")
                .selectExpr("*", "'PASSED' as status"))


def test_user_commands_and_run_gaps(spark, tmp_path):
    root = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex[:8]}"
    fx.users_src(spark, SF_SMALL).write.parquet(f"{root}/src/users")
    store_root = f"{root}/store"
    store = Tables(store_root)
    store.seed(spark, "users_history", fx.users_history(spark, SF_SMALL))
    for night in ("2024-01-20 01:00:00", "2024-01-25 00:00:00.5"):
        assert main(["sync-users", "--store", store_root, "--users", f"{root}/src/users", "--run-ts", night], spark=spark) == 0
    assert store.read(spark, "users_history").where("username like 'office%'").count() == 25
    sc.user_edits(spark, SF_SMALL).write.parquet(f"{root}/edits")
    assert main(["edit-users", "--store", store_root, "--edits", f"{root}/edits"], spark=spark) == 0
    assert store.read(spark, "users_history").where("email_address like 'staff%'").count() > 0
    assert main(["run-gaps", "--store", store_root, "--out", f"{root}/gaps"], spark=spark) == 0
    gaps = read_export(spark, f"{root}/gaps", "job string, gap_start timestamp_ntz, gap_end timestamp_ntz, gap_us long").collect()
    assert [(r.job, r.gap_start.day, r.gap_end.day) for r in gaps] == [("sync_users", 20, 25)]


def test_retries_late_rows_and_the_whole_catalog_over_jdbc(spark, tmp_path):
    root = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex[:8]}"
    url = f"jdbc:derby:memory:cli{uuid.uuid4().hex[:8]};create=true"
    driver = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    props = tmp_path / "db.properties"
    props.write_text("driver=org.apache.derby.jdbc.EmbeddedDriver\n")

    def put(df, name):
        df.toDF(*[c.upper() for c in df.columns]).write.format("jdbc").option("url", url).option("dbtable", name).options(**driver).save()

    put(fx.schemas(spark, SF_SMALL), "NC_ALL_SCHEMAS")
    put(fx.tables(spark, SF_SMALL), "NC_ALL_TABLES")
    put(fx.relstats(spark, SF_SMALL).toDF("OWNER_NAME", "OBJECT_TYPE", "DATABASE", "SCHEMA_NAME", "RELATION", "COMPRESSION_LEVEL", "UNCOMPRESSED_SIZE"),
        "SIZES")
    jdbc = ["--jdbc-properties", str(props), "--catalog", url, "--catalog-schema", "APP"]
    assert main(["list", "tables", "--out", f"{root}/tables", *jdbc], spark=spark) == 0
    want = sc.q_list_tables(spark, SF_SMALL)
    assert same(read_export(spark, f"{root}/tables", want.schema), want)
    sizes = "(SELECT S.*, S.SCHEMA_NAME AS \"SCHEMA\" FROM SIZES S) sized"
    assert main(["list", "sizes", "--out", f"{root}/sizes", "--jdbc-table", sizes, *jdbc], spark=spark) == 0
    want = sc.q_table_sizes(spark, SF_SMALL)
    assert same(read_export(spark, f"{root}/sizes", want.schema), want)

    put(sc.retried_statements(spark, SF_SMALL), "NC_ALL_STATEMENTS")
    store = Tables(f"{root}/store")
    store.seed(spark, "statements_history", fx.statements_history_with_gaps(spark, SF_SMALL))
    source = ["--store", f"{root}/store", "--source", url, "--jdbc-table", "NC_ALL_STATEMENTS", "--jdbc-properties", str(props), "--run-ts", fx.RUN_TS]
    assert main(["capture-statements", *source, "--keep-last-retry"], spark=spark) == 0
    got = store.read(spark, "statements_history")
    assert got.where("retrynum = 3").count() > 0 and got.groupBy("statementid").count().where("count > 1").count() == 0


def test_reports_over_the_stored_histories(spark, tmp_path):
    root = f"{checkpoint_dir(spark)}/cli-{uuid.uuid4().hex[:8]}"
    for name, df in (("statements", fx.statements_sql(spark, SF_SMALL)), ("sessions", fx.sessions_src(spark, SF_SMALL)), ("users", fx.users_src(spark, SF_SMALL)),
                     ("patterns", fx.search_patterns(spark, SF_SMALL))):
        df.write.parquet(f"{root}/src/{name}")
    at = ["--store", f"{root}/store", "--run-ts", fx.RUN_TS]
    assert main(["capture-sessions-users", *at, "--sessions", f"{root}/src/sessions", "--users", f"{root}/src/users"], spark=spark) == 0
    assert main(["capture-statements", *at, "--source", f"{root}/src/statements"], spark=spark) == 0
    assert main(["refresh-sketches", *at], spark=spark) == 0
    held = Tables(f"{root}/store").read(spark, "statements_history").count()
    counts = {}
    for what in ("attribution", "long-statements", "patterns", "shapes", "sessions", "activity", "inactive"):
        extra = ["--patterns", f"{root}/src/patterns"] if what == "patterns" else ["--min-statements", "5"] if what == "long-statements" else []
        # the users were first captured by this run: nobody has been idle before it
        extra += ["--run-ts", "2024-03-01 00:00:00"] if what == "inactive" else []
        assert main(["report", what, *at, "--out", f"{root}/out/{what}", *extra], spark=spark) == 0
        counts[what] = spark.read.option("header", "true").option("sep", "|").option("multiLine", "true").csv(f"{root}/out/{what}").count()
    assert counts["attribution"] == held and counts["sessions"] == Tables(f"{root}/store").read(spark, "sessions_history").count()
    assert all(counts.values()), counts


def test_a_refresh_reads_and_writes_touched_days_only(spark, tmp_path):
    from sysledger.operators import workload
    from sysledger.plans import jobs

    store = Tables(f"{checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex[:8]}")
    store.seed(spark, "sessions_history", sc.all_sessions(spark, SF_SMALL))
    store.seed(spark, "statements_history", fx.statements_history(spark, SF_SMALL))
    jobs.refresh_sketches(spark, store, fx.HISTORY_CUT)
    before = {f for f in store.read(spark, "duration_sketches").inputFiles()}
    jobs.capture_statements(spark, store, fx.statements_src(spark, SF_SMALL), fx.RUN_TS)
    jobs.refresh_sketches(spark, store, fx.RUN_TS)
    after = {f for f in store.read(spark, "duration_sketches").inputFiles()}
    assert {f.split("end_date=")[1][:10] for f in before - after} == {"2024-01-14"}  # the watermark's day
    again = jobs.refresh_sketches(spark, store, fx.RUN_TS).first()
    assert again.extracted == 0 and {f for f in store.read(spark, "duration_sketches").inputFiles()} == after
    owned = workload.owned_statements(store.read(spark, "statements_history"), store.read(spark, "sessions_history"))
    whole = workload.duration_thresholds(workload.duration_sketches(owned), ["dbname"], 0.5).collect()
    assert sorted(map(tuple, workload.duration_thresholds(store.read(spark, "duration_sketches"), ["dbname"], 0.5).select("dbname", "n").collect())) \
        == sorted((r.dbname, r.n) for r in whole)
