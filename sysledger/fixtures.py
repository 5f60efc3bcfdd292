"""Catalog and activity tables derived from the provided parquet tables.

The catalog scripts run on a database's system tables, which are not
available here; these builders shape the given tables into those system
tables (rules in FIXTURES.md). Every builder reads a whole table and is
lazy, so each derived table grows with the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.expr import to_bool, ts_literal
from .sources.catalog import read_catalog

# Fixed times of the test scenario.
RUN_TS = "2024-01-25 00:00:00.5"  # stands for now()
HISTORY_CUT = "2024-01-15 00:00:00"  # history holds rows up to this time
MERGE_WINDOW_LOW = "2024-01-10 00:00:00"  # overlapping window: merges update rows
SINCE = "2024-01-20 00:00:00"  # reach-back bound of the history listings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_catalog(spark, name, f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return c.cast("string")


def _mod(c: str, n: int) -> F.Column:
    return F.col(c) % F.lit(n)


def schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nc_all_schemas: one schema per nation, with the system schema,
    five temporary schemas, a wildcard look-alike and a null name."""
    n = F.col("n_nationkey")
    name = (
        F.when(n == 0, F.lit("nc_system"))
        .when(n == 13, F.lit(None).cast("string"))
        .when(n == 7, F.lit("ncXtemp7"))
        .when(_mod("n_nationkey", 5) == 1, F.concat(F.lit("nc_temp_"), _s(n)))
        .otherwise(F.col("n_name"))
    )
    return table(spark, sf_dir, "nation").select(
        n.alias("schemaid"),
        F.concat(F.lit("db_"), _s(_mod("n_regionkey", 2))).alias("dbname"),
        name.alias("schemaname"),
    )


def tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nc_all_tables: one table per part; schema ids 25, 26 dangle."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("tableid"),
        _mod("p_partkey", 27).cast("int").alias("schemaid"),
        F.col("p_name").alias("tablename"),
        F.col("p_brand").alias("tableowner"),
        F.col("p_type").alias("tabletype"),
        F.when(size % 3 == 0, "none").when(size % 3 == 1, "low").otherwise("high").alias("compresslevel"),
        F.when(size % 2 == 0, "row").otherwise("columnar").alias("storagetype"),
        F.when(size % 5 == 0, F.lit(None).cast("string")).otherwise(F.lit("id")).alias("partitionkey"),
        F.lit(None).cast("string").alias("permissions"),
        F.lit("regular").alias("persistence"),
        (size > 1).alias("valid"),
    )


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nc_all_views: one view per order."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("viewid"),
        _mod("o_orderkey", 27).cast("int").alias("schemaid"),
        F.concat(F.lit("view_"), _s(key)).alias("viewname"),
        F.col("o_orderpriority").alias("viewowner"),
        F.concat(F.lit("select "), _s(F.col("o_custkey"))).alias("viewquery"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("createtime"),
        F.timestamp_add("DAY", _mod("o_orderkey", 30), F.col("o_orderdate").cast("timestamp_ntz")).alias("lastmodtime"),
    )


def functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The installed-functions catalog table: one function per part."""
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("funcid"),
        _mod("p_partkey", 27).cast("int").alias("schemaid"),
        (F.col("p_partkey") + 500000).alias("fileid"),
        F.col("p_name").alias("funcname"),
        F.col("p_brand").alias("funcowner"),
        ts_literal("2023-06-30 08:15:42").alias("creationtime"),
        F.when(size % 2 == 0, "row").otherwise("partition").alias("funcrunnerkind"),
        F.concat(F.lit("select * from "), F.col("p_name"), F.lit("(on t)")).alias("funchelp_usagesyntax"),
        F.col("p_type").alias("funchelp_shortdesc"),
        F.lit(None).cast("string").alias("funchelp_longdesc"),
        F.lit("*").alias("funchelp_inputcols"),
        F.lit("*").alias("funchelp_outputcols"),
        F.col("p_brand").alias("funchelp_author"),
        F.concat(F.lit("1."), _s(size)).alias("funcversion"),
        F.lit("6.20").alias("apiversion"),
        (size % 2 == 0).alias("funcsupports_row"),
        (size % 2 == 1).alias("funcsupports_partition"),
        (size % 3 == 0).alias("funcsupports_multiple_input"),
        F.lit(False).alias("funcsupports_graph"),
        (size % 7 == 0).alias("funcsupports_collaborative_planning"),
    )


def relstats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relation statistics source: one size row per line item, under the
    line's own supplier and part, so the report's groups grow with the data."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("owner_"), _s(F.col("l_suppkey"))).alias("owner_name"),
        F.when(flag == "A", "relation").when(flag == "N", "index").otherwise(F.lit(None).cast("string")).alias("object_type"),
        F.concat(F.lit("db_"), _s(_mod("l_linenumber", 2))).alias("database"),
        F.concat(F.lit("schema_"), _s(F.col("l_suppkey"))).alias("schema"),
        F.concat(F.lit("rel_"), _s(F.col("l_partkey"))).alias("relation"),
        F.when(F.col("l_linestatus") == "F", "none").otherwise("high").alias("compression_level"),
        (F.col("l_orderkey") * 4099 + F.col("l_partkey") * 7 + F.col("l_linenumber")).alias("uncompressed_size"),
    )


def statements_src(spark: SparkSession, sf_dir: str, text: F.Column | None = None) -> DataFrame:
    """nc_all_statements as extracted: booleans still text, running
    statements (null endtime) every 11th event."""
    eid = F.col("event_id")
    ts = F.col("ts").cast("timestamp_ntz")
    return table(spark, sf_dir, "events").select(
        eid.alias("statementid"),
        (eid + 1000000).alias("xactionid"),
        (eid - eid % 4).alias("sessionid"),
        (eid % 3).cast("int").alias("retrynum"),
        (F.col("props") if text is None else text).alias("statement"),
        ts.alias("starttime"),
        F.when(eid % 11 == 0, F.lit(None).cast("timestamp_ntz"))
        .otherwise(F.timestamp_add("SECOND", eid % 600, ts)).alias("endtime"),
        F.when(eid % 2 == 0, "t").otherwise("f").alias("iscancelable"),
    )


def sessions_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nc_all_sessions as extracted: four events in a row are a session (the
    statements' sessionid points at it), from the first to after the last of
    them; every 7th is still open."""
    eid = F.col("event_id")
    sid = F.col("sessionid")
    null_ts, null_long = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("bigint")
    spans = table(spark, sf_dir, "events").groupBy((eid - eid % 4).alias("sessionid")).agg(
        F.min("user_id").alias("uid"), F.min(F.col("ts").cast("timestamp_ntz")).alias("first"),
        F.max(F.col("ts").cast("timestamp_ntz")).alias("last"))
    return spans.select(
        "sessionid",
        F.concat(F.lit("user_"), _s(F.col("uid"))).alias("username"),
        F.concat(F.lit("10.0.0."), _s(F.col("uid") % 250)).alias("clientip"),
        F.concat(F.lit("db_"), _s(F.floor(sid / 4) % 2)).alias("dbname"),
        F.col("first").alias("starttime"),
        F.when(sid % 28 == 0, null_ts).otherwise(F.timestamp_add("SECOND", sid % 3600, F.col("last"))).alias("endtime"),
        null_long.alias("parentsessionid"),
        null_long.alias("parentstatementid"),
        null_long.alias("parenttransactionid"),
        null_long.alias("parentretrynumber"),
    )


def users_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nc_all_users as extracted (booleans as text): all customers, some
    recreated with a new id, some renamed keeping their id; and the nations,
    which the history does not know yet."""
    k = F.col("c_custkey")
    nk = F.col("c_nationkey")
    people = table(spark, sf_dir, "customer").select(
        (F.lit(16384) + k + F.when(k % 17 == 3, F.lit(1000000)).otherwise(F.lit(0))).cast("int").alias("userid"),
        F.when(k % 29 == 7, F.concat(F.lit("renamed_"), _s(k)))
        .otherwise(F.concat(F.lit("user_"), _s(k))).alias("username"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("{sandbox,public}")).alias("schemapath"),
        F.when(nk == 0, "t").otherwise("f").alias("cancreaterole"),
        F.when(nk == 1, "t").otherwise("f").alias("cancreatedb"),
        F.lit("t").alias("autoinheritgrouppriv"),
        F.when(nk < 5, nk).otherwise(F.lit(-1)).cast("int").alias("connlimit"),
    )
    offices = table(spark, sf_dir, "nation").select(
        (F.lit(900000000) + F.col("n_nationkey")).cast("int"), F.concat(F.lit("office_"), _s(F.col("n_nationkey"))),
        F.lit(None).cast("string"), F.lit("f"), F.lit("f"), F.lit("t"), F.lit(-1))
    return people.union(offices)


def users_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users history before a run: all customers, with deleted and
    revoked ones and DBA columns filled in; and the suppliers, which the
    source does not have any more."""
    k = F.col("c_custkey")
    nk = F.col("c_nationkey")
    sk = F.col("s_suppkey")
    null_ts, null_text = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("string")
    first, last = ts_literal("2023-12-01 00:00:00"), ts_literal("2024-01-23 00:00:00")
    deleted, revoked = ts_literal("2023-12-20 01:03:35"), ts_literal("2024-01-16 00:00:00")
    people = table(spark, sf_dir, "customer").select(
        (F.lit(16384) + k).cast("int").alias("userid"),
        F.concat(F.lit("user_"), _s(k)).alias("username"),
        F.when(k % 4 == 0, null_text).when(k % 5 == 0, F.lit("{public}")).otherwise(F.lit("{sandbox,public}")).alias("schemapath"),
        nk.isin(0, 2).alias("cancreaterole"),
        (nk == 1).alias("cancreatedb"),
        F.lit(True).alias("autoinheritgrouppriv"),
        F.when(nk < 5, nk).otherwise(F.lit(-1)).cast("int").alias("connlimit"),
        first.alias("first_captured_time"),
        last.alias("last_activity_time"),
        F.when(k % 19 == 2, deleted).otherwise(null_ts).alias("delete_time"),
        F.when(k % 3 == 1, revoked).otherwise(null_ts).alias("connect_revoked_time"),
        (k % 23 == 0).alias("exempt_activity_flag"),
        F.when(k % 2 == 0, k).otherwise(F.lit(None).cast("bigint")).alias("security_unique_id"),
        F.when(k % 2 == 0, F.concat(F.col("c_name"), F.lit("@example.com"))).otherwise(null_text).alias("email_address"),
        F.col("c_name").alias("full_username"),
    )
    firms = table(spark, sf_dir, "supplier").select(
        (F.lit(800000000) + sk).cast("int"), F.concat(F.lit("firm_"), _s(sk)), F.lit("{public}"), F.lit(False), F.lit(False), F.lit(True),
        F.lit(-1), first, last, F.when(sk % 3 == 0, deleted).otherwise(null_ts), null_ts, F.lit(False), F.lit(None).cast("bigint"),
        null_text, F.col("s_name"))
    return people.union(firms)


def user_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which userid each customer's name had when: some were recreated with a
    new id after half a day, some renamed, some dropped."""
    k = F.col("c_custkey")
    name, uid = F.concat(F.lit("user_"), _s(k)), (F.lit(16384) + k).cast("int")
    first, none = ts_literal("2023-12-01 00:00:00"), F.lit(None).cast("timestamp_ntz")

    def span(n, i, start, end):
        return F.struct(n.alias("username"), i.alias("userid"), start.alias("valid_from"), end.alias("valid_to"))

    gone, back, renamed = ts_literal("2024-01-08 12:00:00"), ts_literal("2024-01-09 00:00:00"), ts_literal("2024-01-12 00:00:00")
    spans = (
        F.when(k % 17 == 3, F.array(span(name, uid, first, gone), span(name, (uid + 1000000).cast("int"), back, none)))
        .when(k % 29 == 7, F.array(span(name, uid, first, renamed), span(F.concat(F.lit("renamed_"), _s(k)), uid, renamed, none)))
        .when(k % 19 == 2, F.array(span(name, uid, first, ts_literal("2024-01-17 00:00:00"))))
        .otherwise(F.array(span(name, uid, first, none)))
    )
    return table(spark, sf_dir, "customer").select(F.inline(spans))


def statements_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statements with SQL as their text: four kinds of call whose
    literals, comments and spacing differ from event to event."""
    eid, uid, kind = _s(F.col("event_id")), _s(F.col("user_id")), F.col("event_type")
    text = (
        F.when(_mod("event_id", 4) == 0, F.concat(F.lit("select "), kind, F.lit(" from sales where id = "), uid, F.lit(" and v > "), eid, F.lit(".5")))
        .when(_mod("event_id", 4) == 1, F.concat(F.lit("INSERT INTO log VALUES ("), eid, F.lit(", '"), kind, F.lit("', "), uid, F.lit(", "),
                                                 _s(_mod("event_id", 7)), F.lit(")")))
        .when(_mod("event_id", 4) == 2, F.concat(F.lit("Select  *\n from t"), _s(_mod("event_id", 3)), F.lit(" where k in (1, 2, "), eid,
                                                 F.lit(") /* run "), eid, F.lit(" -- it's */")))
        .otherwise(F.concat(F.lit("update acct set note = 'it''s -- "), F.col("props"), F.lit("' where id="), uid, F.lit(" -- done "), eid))
    )
    return statements_src(spark, sf_dir, text)


def search_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of search patterns (LIKE): one for each part."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        k.alias("pattern_id"),
        F.when(k % 3 == 0, F.concat(F.lit("%FROM sales where id = "), _s(k), F.lit(" and%")))
        .when(k % 3 == 1, F.concat(F.lit("update%-- done "), _s(k)))
        .otherwise(F.concat(F.lit("%values ("), _s(k), F.lit(", '_l%"))).alias("pattern"))


# --- derived states used by the scenarios -------------------------------

def staged_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users_new after the extract's boolean cast."""
    src = users_src(spark, sf_dir)
    return src.select(
        "userid", "username", "schemapath",
        *[to_bool(c, c).alias(c) for c in ("cancreaterole", "cancreatedb", "autoinheritgrouppriv")],
        "connlimit",
    )


def statements_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement history captured up to the history cut."""
    src = statements_src(spark, sf_dir)
    return src.where(F.col("endtime") <= ts_literal(HISTORY_CUT)).select(
        *[c for c in src.columns if c != "iscancelable"], to_bool("iscancelable").alias("iscancelable"))


def sessions_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Session history captured up to the history cut."""
    src = sessions_src(spark, sf_dir)
    return src.where(F.col("starttime") <= ts_literal(HISTORY_CUT)).withColumn("status", F.lit("PASSED"))


# Statements that reached the source after the window that should have had them.
LATE_EVERY, LATE_PLACE = 13, 5


def statements_history_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement history that never got the late statements."""
    return statements_history(spark, sf_dir).where(F.col("statementid") % LATE_EVERY != LATE_PLACE)
