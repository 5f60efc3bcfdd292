"""
and not from the DataFrame code.

The provided tables are views named after themselves; the derived catalog
tables are the CTEs of FIXTURES.md.
"""

from __future__ import annotations

import re

RUN_TS = "timestamp '2024-01-25 00:00:00.5'"
UPPER = f"date_trunc('second', {RUN_TS})"
CUT = "timestamp '2024-01-15 00:00:00'"
MERGE_LOW = "timestamp '2024-01-10 00:00:00'"
SINCE = "timestamp '2024-01-20 00:00:00'"

# What the staged sessions say of each username.
_PER_USER = f"""
select username, max(starttime) as last_start, max(coalesce(endtime, {RUN_TS})) as last_end
 from {{sessions}} where username is not null group by username"""

# Rows of users with the three facts that the session and deletion rules need.
_FACTS = """
select r.*, p.last_end, coalesce(r.userid not in (select userid from users_new where userid is not null), false) as absent,
 coalesce(bool_or(r.connect_revoked_time < p.last_start) over (partition by r.userid) and r.userid is not null, false) as cleared
 from {rows} r left join {per_user} p using (username)"""

_SYNCED = f"""
select * exclude (last_end, absent, cleared) replace (coalesce(last_end, last_activity_time) as last_activity_time,
  if(absent and delete_time is null, {RUN_TS}, delete_time) as delete_time, if(cleared, null, connect_revoked_time) as connect_revoked_time),
 last_end is not null as act, absent and delete_time is null as del, cleared as clr
 from {{facts}}"""

FX = {
    "fx_schemas": """
select n_nationkey as schemaid, 'db_' || cast(n_regionkey % 2 as varchar(8)) as dbname,
 case when n_nationkey = 0 then 'nc_system' when n_nationkey = 13 then null when n_nationkey = 7 then 'ncXtemp7'
      when n_nationkey % 5 = 1 then 'nc_temp_' || cast(n_nationkey as varchar(8)) else n_name end as schemaname
 from nation""",
    "fx_tables": """
select p_partkey as tableid, cast(p_partkey % 27 as int) as schemaid, p_name as tablename, p_brand as tableowner,
 p_type as tabletype, case when p_size % 3 = 0 then 'none' when p_size % 3 = 1 then 'low' else 'high' end as compresslevel,
 case when p_size % 2 = 0 then 'row' else 'columnar' end as storagetype, case when p_size % 5 = 0 then null else 'id' end as partitionkey,
 cast(null as varchar(8)) as permissions, 'regular' as persistence, p_size > 1 as valid from part""",
    "fx_views": """
select o_orderkey as viewid, cast(o_orderkey % 27 as int) as schemaid, 'view_' || cast(o_orderkey as varchar(20)) as viewname,
 o_orderpriority as viewowner, 'select ' || cast(o_custkey as varchar(20)) as viewquery, o_orderdate as createtime,
 o_orderdate + interval '1' day * (o_orderkey % 30) as lastmodtime from orders""",
    "fx_funcs": """
select p_partkey as funcid, cast(p_partkey % 27 as int) as schemaid, p_partkey + 500000 as fileid, p_name as funcname, p_brand as funcowner,
 timestamp '2023-06-30 08:15:42' as creationtime, case when p_size % 2 = 0 then 'row' else 'partition' end as funcrunnerkind,
 'select * from ' || p_name || '(on t)' as funchelp_usagesyntax, p_type as funchelp_shortdesc, cast(null as varchar(8)) as funchelp_longdesc,
 '*' as funchelp_inputcols, '*' as funchelp_outputcols, p_brand as funchelp_author, '1.' || cast(p_size as varchar(8)) as funcversion, '6.20' as apiversion,
 p_size % 2 = 0 as funcsupports_row, p_size % 2 = 1 as funcsupports_partition, p_size % 3 = 0 as funcsupports_multiple_input,
 false as funcsupports_graph, p_size % 7 = 0 as funcsupports_collaborative_planning from part""",
    "fx_relstats": """
select 'owner_' || cast(l_suppkey as varchar(20)) as owner_name,
 case when l_returnflag = 'A' then 'relation' when l_returnflag = 'N' then 'index' else null end as object_type,
 'db_' || cast(l_linenumber % 2 as varchar(8)) as database, 'schema_' || cast(l_suppkey as varchar(20)) as schema,
 'rel_' || cast(l_partkey as varchar(20)) as relation, case when l_linestatus = 'F' then 'none' else 'high' end as compression_level,
 l_orderkey * 4099 + l_partkey * 7 + l_linenumber as uncompressed_size from lineitem""",
    "fx_statements_src": """
select event_id as statementid, event_id + 1000000 as xactionid, (event_id - event_id % 4) as sessionid, cast(event_id % 3 as int) as retrynum,
 props as statement, ts as starttime, case when event_id % 11 = 0 then null else ts + interval '1' second * (event_id % 600) end as endtime,
 case when event_id % 2 = 0 then 't' else 'f' end as iscancelable from events""",
    "fx_sessions_src": """
select sid as sessionid, 'user_' || cast(uid as varchar) as username, '10.0.0.' || cast(uid % 250 as varchar) as clientip,
 'db_' || cast((sid // 4) % 2 as varchar) as dbname, first_ts as starttime,
 if(sid % 28 = 0, null, last_ts + interval '1' second * (sid % 3600)) as endtime,
 cast(null as bigint) as parentsessionid, cast(null as bigint) as parentstatementid, cast(null as bigint) as parenttransactionid, cast(null as bigint) as parentretrynumber
 from (select event_id - event_id % 4 as sid, min(user_id) as uid, min(ts) as first_ts, max(ts) as last_ts from events group by 1)""",
    "fx_users_src": """
select cast(16384 + c_custkey + case when c_custkey % 17 = 3 then 1000000 else 0 end as int) as userid,
 case when c_custkey % 29 = 7 then 'renamed_' || cast(c_custkey as varchar(20)) else 'user_' || cast(c_custkey as varchar(20)) end as username,
 case when c_custkey % 3 = 0 then null else '{sandbox,public}' end as schemapath,
 case when c_nationkey = 0 then 't' else 'f' end as cancreaterole, case when c_nationkey = 1 then 't' else 'f' end as cancreatedb,
 't' as autoinheritgrouppriv, cast(case when c_nationkey < 5 then c_nationkey else -1 end as int) as connlimit
 from customer
 union all select cast(900000000 + n_nationkey as int), 'office_' || cast(n_nationkey as varchar), null, 'f', 'f', 't', -1 from nation""",
    "fx_users_hist": """
select cast(16384 + c_custkey as int) as userid, 'user_' || cast(c_custkey as varchar(20)) as username,
 case when c_custkey % 4 = 0 then null when c_custkey % 5 = 0 then '{public}' else '{sandbox,public}' end as schemapath,
 c_nationkey in (0, 2) as cancreaterole, c_nationkey = 1 as cancreatedb, true as autoinheritgrouppriv,
 cast(case when c_nationkey < 5 then c_nationkey else -1 end as int) as connlimit,
 timestamp '2023-12-01 00:00:00' as first_captured_time, timestamp '2024-01-23 00:00:00' as last_activity_time,
 case when c_custkey % 19 = 2 then timestamp '2023-12-20 01:03:35' else null end as delete_time,
 case when c_custkey % 3 = 1 then timestamp '2024-01-16 00:00:00' else null end as connect_revoked_time,
 c_custkey % 23 = 0 as exempt_activity_flag, case when c_custkey % 2 = 0 then c_custkey else null end as security_unique_id,
 case when c_custkey % 2 = 0 then c_name || '@example.com' else null end as email_address, c_name as full_username
 from customer
 union all select cast(800000000 + s_suppkey as int), 'firm_' || cast(s_suppkey as varchar), '{public}', false, false, true, -1,
 timestamp '2023-12-01 00:00:00', timestamp '2024-01-23 00:00:00', if(s_suppkey % 3 = 0, timestamp '2023-12-20 01:03:35', null),
 null, false, null, null, s_name from supplier""",
    # statement and session histories as captured up to the cut
    "st_hist": f"""
select statementid, xactionid, sessionid, retrynum, statement, starttime, endtime, iscancelable::boolean as iscancelable
 from fx_statements_src where endtime <= {CUT}""",
    "se_hist": f"""
select *, 'PASSED' as status from fx_sessions_src where starttime <= {CUT}""",
    # staged users after the extract's casts
    "users_new": """
select userid, username, schemapath, cancreaterole::boolean as cancreaterole, cancreatedb::boolean as cancreatedb,
 autoinheritgrouppriv::boolean as autoinheritgrouppriv, connlimit from fx_users_src""",
    # what a run takes: times after the last captured second and before the run
    "st_window": f"""
select if(count(endtime) = 0, timestamp '2000-01-01 00:00:00', time_bucket(interval '1 second', max(endtime))) as after_ts, {UPPER} as before_ts
 from st_hist""",
    "st_new": """
select s.* replace (s.iscancelable::boolean as iscancelable)
 from st_window w join fx_statements_src s on s.endtime > w.after_ts and s.endtime < w.before_ts""",
    "se_window": f"""
select if(count(starttime) = 0, timestamp '2000-01-01 00:00:00', time_bucket(interval '1 second', max(starttime))) as after_ts, {UPPER} as before_ts
 from se_hist""",
    "se_new": """
select s.*, 'PASSED' as status
 from se_window w join fx_sessions_src s on s.starttime > w.after_ts and s.starttime < w.before_ts""",
    "se_overlap": f"""
select sessionid, username, clientip, dbname, starttime, endtime, parentsessionid, parentstatementid, parenttransactionid,
 parentretrynumber, 'PASSED' as status
 from fx_sessions_src where starttime < {UPPER} and starttime > {MERGE_LOW}""",
    "se_rules": f"""
select sessionid, username, clientip, dbname, starttime, endtime, parentsessionid, parentstatementid, parenttransactionid,
 parentretrynumber, 'PASSED' as status
 from fx_sessions_src where starttime < {UPPER} and starttime > {CUT}""",
    # merge of the staged statements into the history
    "st_merged": """
select coalesce(n.statementid, h.statementid) as statementid,
 case when n.statementid is not null then n.xactionid else h.xactionid end as xactionid,
 case when n.statementid is not null then n.sessionid else h.sessionid end as sessionid,
 case when n.statementid is not null then n.retrynum else h.retrynum end as retrynum,
 case when n.statementid is not null then n.statement else h.statement end as statement,
 case when n.statementid is not null then n.starttime else h.starttime end as starttime,
 case when n.statementid is not null then n.endtime else h.endtime end as endtime,
 case when n.statementid is not null then n.iscancelable else h.iscancelable end as iscancelable
 from st_hist h full outer join st_new n on n.statementid = h.statementid""",
    "se_merged": """
select coalesce(n.sessionid, h.sessionid) as sessionid,
 case when n.sessionid is not null then n.username else h.username end as username,
 case when n.sessionid is not null then n.clientip else h.clientip end as clientip,
 case when n.sessionid is not null then n.dbname else h.dbname end as dbname,
 case when n.sessionid is not null then n.starttime else h.starttime end as starttime,
 case when n.sessionid is not null then n.endtime else h.endtime end as endtime,
 case when n.sessionid is not null then n.parentsessionid else h.parentsessionid end as parentsessionid,
 case when n.sessionid is not null then n.parentstatementid else h.parentstatementid end as parentstatementid,
 case when n.sessionid is not null then n.parenttransactionid else h.parenttransactionid end as parenttransactionid,
 case when n.sessionid is not null then n.parentretrynumber else h.parentretrynumber end as parentretrynumber,
 case when n.sessionid is not null then n.status else h.status end as status
 from se_hist h full outer join se_overlap n on n.sessionid = h.sessionid""",
    # user sync. A known user is refreshed when it was deleted or when a pair of
    # present values differs.
    "u1": """
select coalesce(n.username is not null and (h.delete_time is not null or len(list_filter(
   [(h.userid::varchar, n.userid::varchar), (h.connlimit::varchar, n.connlimit::varchar), (h.schemapath, n.schemapath),
    (h.autoinheritgrouppriv::varchar, n.autoinheritgrouppriv::varchar), (h.cancreatedb::varchar, n.cancreatedb::varchar),
    (h.cancreaterole::varchar, n.cancreaterole::varchar)],
   lambda p: p[1] is not null and p[2] is not null and p[1] <> p[2])) > 0), false) as chg, h.*
 from users_new n right join fx_users_hist h using (username)""",
    "h1": """
select * exclude (chg) from u1 where not chg
union all by name
select n.*, u.first_captured_time, u.last_activity_time, cast(null as timestamp) as delete_time, u.connect_revoked_time, u.exempt_activity_flag,
 u.security_unique_id, u.email_address, u.full_username
 from u1 u join users_new n using (username) where u.chg""",
    # The rules of the sync as facts about each row, in one derivation: who is
    # new, what the staged sessions say of a username, whether the id is still
    # in the source, and whether an id has a row to be cleared.
    "newcomers": f"""
select *, {RUN_TS} as first_captured_time, {RUN_TS} as last_activity_time, false as exempt_activity_flag
 from users_new anti join h1 using (username)""",
    "roster": "from h1 union all by name from newcomers",
    "per_user": _PER_USER.format(sessions="se_rules"),
    "facts": _FACTS.format(rows="roster", per_user="per_user"),
    "synced": _SYNCED.format(facts="facts"),
}

FX["se_merged_new"] = FX["se_merged"].replace("se_overlap", "se_new")
_SESSION_STEPS = ["per_user", "facts", "synced"]


def _rename_chain(body: str, prefix: str, sessions: str) -> str:
    body = re.sub(r"\bse_rules\b", sessions, body)
    for n in _SESSION_STEPS:
        body = re.sub(rf"\b{n}\b", prefix + n, body)
    return body


# the same user steps fed by the sessions a watermark run stages (B4)
for _n in _SESSION_STEPS:
    FX["b4_" + _n] = _rename_chain(FX[_n], "b4_", "se_new")

USER_COLS = ("userid, username, schemapath, cancreaterole, cancreatedb, autoinheritgrouppriv, connlimit, first_captured_time, "
             "last_activity_time, delete_time, connect_revoked_time, exempt_activity_flag, security_unique_id, email_address, "
             "full_username")


def _with(names: list[str], body: str) -> str:
    ctes = ",\n".join(f"{n} as ({FX[n].strip()})" for n in names)
    return f"with {ctes}\n{body.strip()}"


# dependency order of the CTEs
_ORDER = list(FX)
_DEPS = {
    "st_hist": ["fx_statements_src"], "se_hist": ["fx_sessions_src"], "users_new": ["fx_users_src"],
    "st_window": ["st_hist"], "st_new": ["fx_statements_src", "st_window"],
    "se_window": ["se_hist"], "se_new": ["fx_sessions_src", "se_window"],
    "se_overlap": ["fx_sessions_src"], "se_rules": ["fx_sessions_src"],
    "st_merged": ["st_hist", "st_new"], "se_merged": ["se_hist", "se_overlap"],
    "u1": ["fx_users_hist", "users_new"], "h1": ["u1", "users_new"], "newcomers": ["users_new", "h1"],
    "roster": ["h1", "newcomers"], "per_user": ["se_rules"], "facts": ["roster", "per_user", "users_new"], "synced": ["facts"],
    "se_merged_new": ["se_hist", "se_new"],
}
for _n in _SESSION_STEPS:
    _DEPS["b4_" + _n] = [("b4_" + d if d in _SESSION_STEPS else ("se_new" if d == "se_rules" else d)) for d in _DEPS[_n]]


def sql(body: str, *needs: str) -> str:
    seen: set[str] = set()

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in _DEPS.get(n, []):
            visit(d)
        seen.add(n)

    for n in needs:
        visit(n)
    return _with([n for n in _ORDER if n in seen], body)


def _single_step(step: str) -> str:
    """Users history after only one of the five rules: the same facts, about
    the rows of the history before the run."""
    if step == "update":
        return sql(f"select {USER_COLS} from h1", "h1")
    if step == "insert":
        return sql(f"""
select {USER_COLS} from (from fx_users_hist union all by name (
 select *, {RUN_TS} as first_captured_time, {RUN_TS} as last_activity_time, false as exempt_activity_flag
  from users_new anti join fx_users_hist using (username)))""", "fx_users_hist", "users_new")
    changed = {"activity": f"coalesce(last_end, last_activity_time) as last_activity_time",
               "delete": f"if(absent and delete_time is null, {RUN_TS}, delete_time) as delete_time",
               "revoke": "if(cleared, null, connect_revoked_time) as connect_revoked_time"}[step]
    return sql(f"select {USER_COLS} from (select * replace ({changed}) from ({_FACTS.format(rows='fx_users_hist', per_user='per_user')}))",
               "fx_users_hist", "per_user", "users_new")


def _size_of(table: str, parts: list[str], schema: str) -> str:
    total = " + ".join(f"coalesce({p}, 0)" for p in parts)
    return (f"select 'dba' as owner_name, 'relation' as object_type, 'db_0' as database, '{schema}' as schema, "
            f"'{table}' as relation, 'none' as compression_level, cast({total} as bigint) as uncompressed_size from {table}")


_MERGE_COUNTS = """
select '{job}' as job, 'merge' as step, (select count(1) from {new}) as extracted,
 (select count(1) from {new} n where not exists (select 1 from {hist} h where h.{key} = n.{key})) as inserted,
 (select count(1) from {hist} h where exists (select 1 from {new} n where n.{key} = h.{key})) as updated"""

# DBA edits of building-segment customers, all five columns
_EDITED = sql(f"""
select {USER_COLS} from (
 select h.* replace (if(hit, e.full_username, h.full_username) as full_username, if(hit, true, h.exempt_activity_flag) as exempt_activity_flag,
   if(hit, e.revoked, h.connect_revoked_time) as connect_revoked_time, if(hit, e.code, h.security_unique_id) as security_unique_id,
   if(hit, e.mail, h.email_address) as email_address)
  from fx_users_hist h left join (
   select true as hit, 'user_' || cast(c_custkey as varchar) as username, c_name || ' (' || c_mktsegment || ')' as full_username,
          if(c_nationkey < 12, {RUN_TS}, null) as revoked, c_custkey + 5000000 as code, 'staff' || cast(c_custkey as varchar) || '@example.org' as mail
     from customer where c_mktsegment = 'BUILDING') e on e.username = h.username)""", "fx_users_hist")

# The columns of each listing, as reports of the catalog show them.
TABLE_COLUMNS = ("tableid, dbname, schemaid, schemaname, tablename, tableowner, tabletype, compresslevel, storagetype, partitionkey, permissions, "
                 "persistence, valid")
VIEW_COLUMNS = "viewid, dbname, schemaid, schemaname, viewname, viewowner, viewquery, createtime, lastmodtime"
FUNCTION_COLUMNS = ("funcid, dbname, schemaid, schemaname, fileid, funcname, funcowner, creationtime, funcrunnerkind, funchelp_usagesyntax, "
                    "funchelp_shortdesc, funchelp_longdesc, funchelp_inputcols, funchelp_outputcols, funchelp_author, funcversion, apiversion, "
                    "funcsupports_row, funcsupports_partition, funcsupports_multiple_input, funcsupports_graph, funcsupports_collaborative_planning")
# Listed schemas have a name that is not "nc", any character, "temp" and more.
FX["listed"] = "select * from fx_schemas where not regexp_full_match(schemaname, '(?s)nc.temp.*')"
_DEPS["listed"] = ["fx_schemas"]
_ORDER.append("listed")


def _listing(columns: str, objects: str, only: str = "true") -> str:
    return sql(f"select {columns} from listed natural join {objects} where {only}", "listed", objects)


ORACLE: dict[str, str] = {
    "list_schemas": sql("from listed", "listed"),
    "list_tables": _listing(TABLE_COLUMNS, "fx_tables"),
    "list_views": _listing(VIEW_COLUMNS, "fx_views", "schemaname != 'nc_system'"),
    "list_functions": _listing(FUNCTION_COLUMNS, "fx_funcs"),
    "list_sessions_history": sql("""
select sessionid, username, clientip, dbname, starttime, endtime, parentsessionid, parentstatementid,
 parenttransactionid, parentretrynumber, status from se_hist""", "se_hist"),
    "list_sessions_since": sql(f"""
select sessionid, username, clientip, dbname, starttime, endtime, parentsessionid, parentstatementid,
 parenttransactionid, parentretrynumber, status from se_merged where starttime > {SINCE}""", "se_merged"),
    "list_statements_history": sql("""
select statementid, xactionid, sessionid, retrynum, statement, starttime, endtime, iscancelable from st_hist""", "st_hist"),
    "list_statements_since": sql(f"""
select statementid, xactionid, sessionid, retrynum, statement, starttime, endtime, iscancelable
 from st_merged where starttime > {SINCE}""", "st_merged"),
    "list_users_history": sql("""
select userid, username, schemapath, cancreaterole, cancreatedb, autoinheritgrouppriv, connlimit,
 first_captured_time, last_activity_time, delete_time from fx_users_hist order by username""", "fx_users_hist"),
    "table_sizes": sql("""
select * exclude (uncompressed_size), (sum(uncompressed_size) / 1048576)::decimal(14,6) as "MB Uncompressed" from (
 select owner_name as "owner", if(object_type = 'relation', 'table', object_type) as "tbl/idx", database, schema, relation as "name",
        compression_level as "cmp lvl", uncompressed_size from fx_relstats) group by all""", "fx_relstats"),
    "relation_stats": "\nunion all\n".join([
        _size_of("documents", ["8 * count(doc_id)", "sum(strlen(text))", "sum(strlen(lang))", "sum(strlen(source))",
                               "8 * count(n_chars)"], "corpus"),
        _size_of("pages", ["8 * count(page_id)", "sum(strlen(url))", "sum(strlen(html))"], "web"),
        _size_of("conversations", ["8 * count(conv_id)", "8 * count(turn)", "sum(strlen(role))", "sum(strlen(text))"], "chat"),
        _size_of("embeddings", ["8 * count(vec_id)", "sum(4 * len(embedding))", "4 * count(label)"], "vectors"),
    ]),
    "watermark_statements": sql("select after_ts as watermark, before_ts as upper_bound from st_window", "st_window"),
    "watermark_sessions": sql("select after_ts as watermark, before_ts as upper_bound from se_window", "se_window"),
    "watermark_empty": sql(f"""
select coalesce(date_trunc('second', max(endtime)), timestamp '2000-01-01 00:00:00') as watermark, {UPPER} as upper_bound
 from fx_statements_src where endtime < timestamp '2000-01-01'""", "fx_statements_src"),
    "extract_statements": sql("select * from st_new", "st_new"),
    "extract_sessions": sql("select * from se_new", "se_new"),
    "extract_users": sql("select * from users_new", "users_new"),
    "extract_counts": sql("""
select 'statements' as source, count(1) as extracted from st_new
union all select 'sessions', count(1) from se_new
union all select 'users', count(1) from users_new""", "st_new", "se_new", "users_new"),
    "merge_statements": sql("select * from st_merged", "st_merged"),
    "merge_sessions": sql("select * from se_merged", "se_merged"),
    "merge_counts": sql("""
select 'statements' as target, (select count(1) from st_new) as extracted,
 (select count(1) from st_new n where not exists (select 1 from st_hist h where h.statementid = n.statementid)) as inserted,
 (select count(1) from st_hist h where exists (select 1 from st_new n where n.statementid = h.statementid)) as updated
union all
select 'sessions', (select count(1) from se_overlap),
 (select count(1) from se_overlap n where not exists (select 1 from se_hist h where h.sessionid = n.sessionid)),
 (select count(1) from se_hist h where exists (select 1 from se_overlap n where n.sessionid = h.sessionid))""",
                        "st_new", "st_hist", "se_overlap", "se_hist"),
    "users_update_changed": _single_step("update"),
    "users_insert_new": _single_step("insert"),
    "users_last_activity": _single_step("activity"),
    "users_soft_delete": _single_step("delete"),
    "users_clear_revoked": _single_step("revoke"),
    "sync_users": sql(f"select {USER_COLS} from synced", "synced"),
    "sync_user_counts": sql("""
select (select count(*) from u1 where chg) as updated, (select count(*) from newcomers) as inserted,
 (select count(*) from synced where act) as activity_set, (select count(*) from synced where del) as soft_deleted,
 (select count(*) from synced where clr) as revoke_cleared""", "u1", "newcomers", "synced"),
    "set_user_attributes": _EDITED,
    "job_edit_users": _EDITED,
    "statements_matching": sql("""
select s.statementid, s.sessionid, se.username, se.dbname, u.userid, u.user_deleted, s.starttime, s.endtime
 from (from fx_statements_src where regexp_matches(lower(statement), '"k": *[0-9]*7[^0-9]|drop +table')) s
 left join fx_sessions_src se on se.sessionid = s.sessionid
 left join (select username, max(userid) as userid, bool_or(delete_time is not null) as user_deleted
              from fx_users_hist group by username) u on u.username = se.username""",
                               "fx_statements_src", "fx_sessions_src", "fx_users_hist"),
    "time_text": sql("""
select statementid, strftime(endtime, '%m/%d/%Y %H:%M:%S') as shown, date_trunc('second', endtime) as back from fx_statements_src""",
                     "fx_statements_src"),
    "run_gaps": """
select job, gap_start, gap_end, epoch_us(gap_end) - epoch_us(gap_start) as gap_us from (
  select job, lag(run_ts) over (partition by job order by run_ts) as gap_start, run_ts as gap_end
    from (select 'capture_' || o_orderpriority as job, cast(o_orderdate as timestamp) + interval '1' hour * (o_orderkey % 24) as run_ts from orders))
 where gap_start is not null and epoch_us(gap_end) - epoch_us(gap_start) >= cast(72 as bigint) * 3600000000""",
    "job_capture_retried": sql("""
select statementid, xactionid, sessionid, if(fresh and retrynum = 2, 3, retrynum)::int as retrynum,
 statement || if(fresh and retrynum = 2, ' -- again', '') as statement, starttime, endtime, iscancelable
 from (select *, statementid in (select statementid from st_new) as fresh from st_merged)""", "st_merged", "st_new"),
    "align_schema": sql("""
select sessionid, username, clientip, dbname, starttime, endtime, cast(null as bigint) as parentsessionid,
 cast(null as bigint) as parentstatementid, cast(null as bigint) as parenttransactionid,
 cast(null as bigint) as parentretrynumber, status from se_hist""", "se_hist"),
    "statement_attribution": sql("""
select s.statementid, s.sessionid, se.username, se.dbname, u.userid, u.user_deleted, s.starttime, s.endtime
 from fx_statements_src s
 left join fx_sessions_src se on se.sessionid = s.sessionid
 left join (select username, max(userid) as userid, bool_or(delete_time is not null) as user_deleted
              from fx_users_hist group by username) u on u.username = se.username""",
                                 "fx_statements_src", "fx_sessions_src", "fx_users_hist"),
    "long_running": sql("""
select statementid, sessionid, starttime, endtime, epoch_us(endtime) - epoch_us(starttime) as duration_us
 from fx_statements_src where endtime is not null and epoch_us(endtime) - epoch_us(starttime) >= cast(300 as bigint) * 1000000""",
                        "fx_statements_src"),
    "inactive_users": sql(f"""
select userid, username, last_activity_time, first_captured_time from synced
 where delete_time is null and connect_revoked_time is null and not coalesce(exempt_activity_flag, false)
   and coalesce(last_activity_time, first_captured_time) < {RUN_TS} - interval '1' day""", "synced"),
    "capture_gaps": sql("""
select gap_start, gap_end, epoch_us(gap_end) - epoch_us(gap_start) as gap_us from (
  select lag(starttime) over (order by starttime) as gap_start, starttime as gap_end
    from fx_sessions_src where starttime is not null)
 where gap_start is not null and epoch_us(gap_end) - epoch_us(gap_start) > cast(3600 as bigint) * 1000000""", "fx_sessions_src"),
    "job_capture_statements": sql("select * from st_merged", "st_merged"),
    "job_capture_sessions": sql("select * from se_merged_new", "se_merged_new"),
    "job_sync_users": sql(f"select {USER_COLS} from b4_synced", "b4_synced"),
    "job_list_sessions_since": sql(f"""
select sessionid, username, clientip, dbname, starttime, endtime, parentsessionid, parentstatementid,
 parenttransactionid, parentretrynumber, status from se_merged_new where starttime > {SINCE}""", "se_merged_new"),
    "job_metrics": sql(
        _MERGE_COUNTS.format(job="capture_statements", new="st_new", hist="st_hist", key="statementid")
        + "\nunion all" + _MERGE_COUNTS.format(job="capture_sessions", new="se_new", hist="se_hist", key="sessionid")
        + """
union all select 'sync_users', 'extract_users', (select count(1) from users_new), null, null
union all select 'sync_users', 'update_changed', null, 0, (select count(*) from u1 where chg)
union all select 'sync_users', 'insert_new', null, (select count(*) from newcomers), 0
union all select 'sync_users', 'last_activity', null, 0, (select count(*) from b4_synced where act)
union all select 'sync_users', 'soft_delete', null, 0, (select count(*) from b4_synced where del)
union all select 'sync_users', 'clear_revoked', null, 0, (select count(*) from b4_synced where clr)""",
        "st_new", "st_hist", "se_new", "se_hist", "users_new", "u1", "newcomers", "b4_synced"),
    "compact": sql("select * from st_merged", "st_merged"),
    "export_text": None,
}
ORACLE["export_text"] = ORACLE["list_tables"]
ORACLE["job_sync_users_alone"] = ORACLE["job_sync_users"]
ORACLE["relation_sizes"] = """
select owner_name as "owner", 'table' as "tbl/idx", database, schema, relation as "name", compression_level as "cmp lvl",
 (uncompressed_size / (1024 * 1024))::decimal(14,6) as "MB Uncompressed" from (""" + ORACLE["relation_stats"] + ")"

# --- spans, late rows, intervals, workload -------------------------------------

FX["fx_spans"] = """
select username, userid::int as userid, valid_from::timestamp as valid_from, valid_to::timestamp as valid_to from (
 select 'user_' || c_custkey::varchar as username, 16384 + c_custkey as userid, '2023-12-01 00:00:00' as valid_from,
   case when c_custkey % 17 = 3 then '2024-01-08 12:00:00' when c_custkey % 29 = 7 then '2024-01-12 00:00:00'
        when c_custkey % 19 = 2 then '2024-01-17 00:00:00' end as valid_to from customer
 union all select 'user_' || c_custkey::varchar, 1016384 + c_custkey, '2024-01-09 00:00:00', null from customer where c_custkey % 17 = 3
 union all select 'renamed_' || c_custkey::varchar, 16384 + c_custkey, '2024-01-12 00:00:00', null from customer
   where c_custkey % 29 = 7 and c_custkey % 17 <> 3)"""
FX["fx_statements_sql"] = """
select event_id as statementid, event_id - event_id % 4 as sessionid, ts as starttime,
 if(event_id % 11 = 0, null, ts + to_seconds(event_id % 600)) as endtime,
 case event_id % 4
   when 0 then concat('select ', event_type, ' from sales where id = ', user_id, ' and v > ', event_id, '.5')
   when 1 then concat('INSERT INTO log VALUES (', event_id, ', ''', event_type, ''', ', user_id, ', ', event_id % 7, ')')
   when 2 then concat('Select  *', chr(10), ' from t', event_id % 3, ' where k in (1, 2, ', event_id, ') /* run ', event_id, ' -- it''s */')
   else concat('update acct set note = ''it''''s -- ', props, ''' where id=', user_id, ' -- done ', event_id) end as statement
 from events"""
FX["gap_hist"] = "select * from st_hist where statementid % 13 <> 5"
FX["late"] = """
select s.* replace (s.iscancelable::boolean as iscancelable) from fx_statements_src s
 where s.endtime <= (select time_bucket(interval '1 second', max(endtime)) from gap_hist) and s.statementid not in (select statementid from gap_hist)"""
FX["user_islands"] = f"""
select username, min(s) as merged_from, max(e) as merged_to, count(*) as n from (
 select *, count(*) filter (apart) over (partition by username order by s, e rows unbounded preceding) as island from (
  select *, coalesce(s > max(e) over (partition by username order by s, e rows between unbounded preceding and 1 preceding) + to_seconds({{gap}}), true) as apart
   from (select username, starttime as s, greatest(coalesce(endtime, {RUN_TS}), starttime) as e from fx_sessions_src where starttime <= {RUN_TS})))
 group by username, island"""
FX["owned"] = "select s.*, p.username, p.dbname from fx_statements_src s left join (select sessionid, username, dbname from fx_sessions_src) p using (sessionid)"
_DEPS |= {"gap_hist": ["st_hist"], "late": ["fx_statements_src", "gap_hist"],
          "user_islands": ["fx_sessions_src"], "owned": ["fx_statements_src", "fx_sessions_src"]}
FX["people"] = f"""
select username, userid, first_captured_time as since, least(coalesce(delete_time, {RUN_TS}), {RUN_TS}) as until
 from fx_users_hist where not exempt_activity_flag"""
_DEPS["people"] = ["fx_users_hist"]
_IDLE = FX["user_islands"].replace("{gap}", str(12 * 3600 - 1))
FX["user_islands"] = FX["user_islands"].replace("{gap}", "0")
FX["idle_islands"] = _IDLE
_DEPS["idle_islands"] = ["fx_sessions_src"]
_ORDER += [n for n in FX if n not in _ORDER]

ORACLE["attribution_as_of"] = sql("""
select s.statementid, s.sessionid, p.username, p.dbname, x.userid, n.username as name_now,
 if(x.userid is null, null, x.valid_to is not null) as user_dropped, s.starttime, s.endtime
 from fx_statements_src s left join fx_sessions_src p using (sessionid)
 left join fx_spans x on x.username = p.username and x.valid_from <= s.starttime and (x.valid_to > s.starttime or x.valid_to is null)
 left join (select userid, arg_max(username, valid_from) as username from fx_spans group by userid) n on n.userid = x.userid""",
                                  "fx_statements_src", "fx_sessions_src", "fx_spans")
ORACLE["user_spans"] = sql(f"""
with before as (select username, userid, first_captured_time as valid_from, delete_time as valid_to from fx_users_hist),
 listed as (select distinct username, userid from users_new)
select * from before where valid_to is not null
union all select username, userid, valid_from, if((username, userid) in (from listed), null, {RUN_TS}) from before where valid_to is null
union all select username, userid, {RUN_TS}, null from listed anti join (select * from before where valid_to is null) using (username, userid)""",
                           "fx_users_hist", "users_new").replace(")\nwith before", "),\nbefore")
ORACLE["job_user_spans"] = ORACLE["user_spans"]
ORACLE["missed_statements"] = sql("from late", "late")
ORACLE["job_reconcile_statements"] = sql("from gap_hist union all by name from late", "gap_hist", "late")
ORACLE["user_activity"] = sql("from user_islands", "user_islands")
ORACLE["mixed_sessions"] = sql("""
select * replace (if((sessionid // 4) % 4 = 3, sessionid - 4, null) as parentsessionid) from se_hist""", "se_hist")
ORACLE["closed_sessions"] = sql(f"""
select p.sessionid, p.username, p.dbname, p.starttime, p.endtime,
 coalesce(p.endtime, if(coalesce(b.last, p.starttime) + interval '6 hours' < {RUN_TS}, coalesce(b.last, p.starttime), null)) as effective_end,
 case when p.endtime is not null then 'recorded' when coalesce(b.last, p.starttime) + interval '6 hours' < {RUN_TS} then 'derived' else 'open' end as end_source,
 coalesce(b.bursts, 0) as bursts, coalesce(b.busy, 0)::bigint as busy_us
 from fx_sessions_src p left join (
  select sessionid, max(e) as last, count(*) as bursts, sum(epoch_us(e) - epoch_us(s)) as busy from (
   select sessionid, min(s) as s, max(e) as e from (
    select *, count(*) filter (apart) over (partition by sessionid order by s, e rows unbounded preceding) as burst from (
     select *, coalesce(s > max(e) over (partition by sessionid order by s, e rows between unbounded preceding and 1 preceding) + interval '6 hours', true) as apart
      from (select t.sessionid, t.starttime as s, greatest(least(coalesce(t.endtime, {RUN_TS}), {RUN_TS}), t.starttime) as e
             from fx_statements_src t semi join (select * from fx_sessions_src where endtime is null) using (sessionid) where t.starttime < {RUN_TS})))
    group by sessionid, burst) group by sessionid) b using (sessionid)""", "fx_sessions_src", "fx_statements_src")
ORACLE["inactive_stretches"] = sql(f"""
select username, userid, f as idle_from, t as idle_to, epoch_us(t) - epoch_us(f) as idle_us, kind from (
 select u.username, u.userid, u.since as f, u.until as t, 'never' as kind from people u anti join idle_islands using (username)
 union all select u.username, u.userid, u.since, least(i.first, u.until), 'before'
  from people u join (select username, min(merged_from) as first from idle_islands group by username) i using (username)
 union all select u.username, u.userid, greatest(i.merged_to, u.since), least(coalesce(i.following, u.until), u.until), if(i.following is null, 'after', 'between')
  from people u join (select *, lead(merged_from) over (partition by username order by merged_from) as following from idle_islands) i using (username))
 where epoch_us(t) - epoch_us(f) >= cast(12 * 3600 as bigint) * 1000000""", "idle_islands", "people")
ORACLE["unusually_long"] = sql("""
select statementid, sessionid, dbname, username, d as duration_us, threshold_us, n as group_statements from (
 select *, max(case when place = ceil(0.95 * n) then d end) over (partition by dbname, username) as threshold_us from (
  select *, epoch_us(endtime) - epoch_us(starttime) as d, count(*) over (partition by dbname, username) as n,
   row_number() over (partition by dbname, username order by epoch_us(endtime) - epoch_us(starttime)) as place
   from owned where endtime is not null)) where n >= 20 and d > threshold_us""", "owned")
ORACLE["job_thresholds"] = sql("""
select dbname, username, count(*) as n, list(d order by d)[ceil(0.95 * count(*))::int] as threshold_us from (
 select p.dbname, p.username, epoch_us(s.endtime) - epoch_us(s.starttime) as d
  from st_merged s left join se_merged_new p using (sessionid) where s.endtime is not null) group by dbname, username""", "st_merged", "se_merged_new")
ORACLE["pattern_matches"] = sql("""
select s.statementid, p.pattern_id from fx_statements_sql s join (
 select p_partkey as pattern_id, case p_partkey % 3 when 0 then '%from sales where id = ' || p_partkey || ' and%'
   when 1 then 'update%-- done ' || p_partkey else '%values (' || p_partkey || ', ''_l%' end as pattern from part) p on lower(s.statement) like p.pattern""",
                                "fx_statements_sql")
_TOKENS = (r"""'[^']*'?|--[^\n]*|/\*[\s\S]*?(?:\*/|\z)|"[^"]*"?|[0-9]+(?:[.][0-9]+)?(?:[eE][-+]?[0-9]+)?|[A-Za-z_][A-Za-z0-9_$]*"""
           r"""|[^ \t\n\r\f\x0B]""").replace("'", "''")
ORACLE["statement_shapes"] = sql(f"""
with shaped as (
 select p.dbname, p.username, epoch_us(s.endtime) - epoch_us(s.starttime) as d, regexp_replace(regexp_replace(array_to_string(list_transform(
   list_filter(regexp_extract_all(s.statement, '{_TOKENS}'), lambda t: not (starts_with(t, '--') or starts_with(t, '/*'))),
   lambda t: case when regexp_matches(t, '^[0-9'']') then '?' when starts_with(t, '"') then t else lower(t) end), ' '),
   '\\?( \\?)+', '?', 'g'), '\\?( , \\?)+', '?', 'g') as shape
 from fx_statements_sql s left join fx_sessions_src p using (sessionid) where s.endtime is not null),
grouped as (
 select dbname, grouping(dbname) = 1 as all_databases, shape, count(*) as calls, count(distinct username) as users, sum(d)::bigint as total_us,
  max(d) as longest_us from shaped group by grouping sets ((dbname, shape), (shape)))
select *, row_number() over (partition by all_databases, dbname order by total_us desc, shape)::int as place from grouped qualify place <= 20""",
                                 "fx_statements_sql", "fx_sessions_src").replace(")\nwith shaped", "),\nshaped")
