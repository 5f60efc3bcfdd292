"""Data-dictionary listings: schemas, tables, views and functions of the
catalog, and the three history tables.

Each catalog listing joins the (large) object table to the (small) schema
table on ``schemaid``. The schema side is filtered first and broadcast
after a size check, so the object table is scanned once, never shuffled,
and only the listed columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import SYSTEM_SCHEMA, not_temp_schema, ts_literal
from ..plans.hints import broadcast_if_small

TABLE_COLUMNS = [
    "tableid", "dbname", "schemaid", "schemaname", "tablename", "tableowner", "tabletype",
    "compresslevel", "storagetype", "partitionkey", "permissions", "persistence", "valid",
]

VIEW_COLUMNS = [
    "viewid", "dbname", "schemaid", "schemaname", "viewname", "viewowner", "viewquery",
    "createtime", "lastmodtime",
]

FUNCTION_COLUMNS = [
    "funcid", "dbname", "schemaid", "schemaname", "fileid", "funcname", "funcowner", "creationtime",
    "funcrunnerkind", "funchelp_usagesyntax", "funchelp_shortdesc", "funchelp_longdesc",
    "funchelp_inputcols", "funchelp_outputcols", "funchelp_author", "funcversion", "apiversion",
    "funcsupports_row", "funcsupports_partition", "funcsupports_multiple_input", "funcsupports_graph",
    "funcsupports_collaborative_planning",
]

SESSION_HISTORY_COLUMNS = [
    "sessionid", "username", "clientip", "dbname", "starttime", "endtime", "parentsessionid",
    "parentstatementid", "parenttransactionid", "parentretrynumber", "status",
]

STATEMENT_HISTORY_COLUMNS = [
    "statementid", "xactionid", "sessionid", "retrynum", "statement", "starttime", "endtime", "iscancelable",
]

# The users listing shows 10 of the history's 15 columns.
USER_HISTORY_COLUMNS = [
    "userid", "username", "schemapath", "cancreaterole", "cancreatedb", "autoinheritgrouppriv",
    "connlimit", "first_captured_time", "last_activity_time", "delete_time",
]


def list_schemas(schemas: DataFrame) -> DataFrame:
    """All schemas except temporary ones (every column)."""
    return schemas.where(not_temp_schema("schemaname"))


def _with_schema(objects: DataFrame, schemas: DataFrame, columns: list[str], *, exclude_system: bool = False) -> DataFrame:
    keep = not_temp_schema("schemaname")
    if exclude_system:
        keep = keep & (F.col("schemaname") != F.lit(SYSTEM_SCHEMA))
    side = schemas.where(keep).select("schemaid", "dbname", "schemaname")
    return objects.join(broadcast_if_small(side), "schemaid", "inner").select(*columns)


def list_tables(tables: DataFrame, schemas: DataFrame) -> DataFrame:
    """Tables with their database and schema, temporary schemas left out."""
    return _with_schema(tables, schemas, TABLE_COLUMNS)


def list_views(views: DataFrame, schemas: DataFrame) -> DataFrame:
    """Views, leaving out temporary schemas and the system schema."""
    return _with_schema(views, schemas, VIEW_COLUMNS, exclude_system=True)


def list_functions(funcs: DataFrame, schemas: DataFrame) -> DataFrame:
    """Installed functions, temporary schemas left out."""
    return _with_schema(funcs, schemas, FUNCTION_COLUMNS)


def _since(df: DataFrame, since) -> DataFrame:
    # Reach-back bound; a literal, so it reaches the parquet scan (and the
    # date partitions of a history snapshot).
    return df if since is None else df.where(F.col("starttime") > ts_literal(since))


def list_sessions_history(history: DataFrame, since=None) -> DataFrame:
    return _since(history, since).select(*SESSION_HISTORY_COLUMNS)


def list_statements_history(history: DataFrame, since=None) -> DataFrame:
    return _since(history, since).select(*STATEMENT_HISTORY_COLUMNS)


def list_users_history(history: DataFrame, ordered: bool = False) -> DataFrame:
    out = history.select(*USER_HISTORY_COLUMNS)
    return out.orderBy(F.col("username").asc_nulls_last()) if ordered else out
