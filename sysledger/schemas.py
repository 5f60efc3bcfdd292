"""Table definitions of the staging and history tables, their layout
intent, and schema alignment for older history snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _field(name: str, dtype: T.DataType, max_len: int | None = None) -> T.StructField:
    # varchar(n) / char(n) lengths are kept as metadata; StringType does not
    # enforce them.
    meta = {"max_length": max_len} if max_len else {}
    return T.StructField(name, dtype, True, meta)


STATEMENTS = T.StructType([
    _field("statementid", T.LongType()),
    _field("xactionid", T.LongType()),
    _field("sessionid", T.LongType()),
    _field("retrynum", T.IntegerType()),
    _field("statement", T.StringType()),
    _field("starttime", T.TimestampNTZType()),
    _field("endtime", T.TimestampNTZType()),
    _field("iscancelable", T.BooleanType()),
])

# The four parent* columns arrived with database release 6.20; older
# history snapshots lack them (see align_schema).
SESSION_PARENT_COLUMNS = ["parentsessionid", "parentstatementid", "parenttransactionid", "parentretrynumber"]

SESSIONS = T.StructType([
    _field("sessionid", T.LongType()),
    _field("username", T.StringType()),
    _field("clientip", T.StringType(), 16),
    _field("dbname", T.StringType()),
    _field("starttime", T.TimestampNTZType()),
    _field("endtime", T.TimestampNTZType()),
    *[_field(c, T.LongType()) for c in SESSION_PARENT_COLUMNS],
    _field("status", T.StringType(), 20),
])

SESSIONS_PRE_620 = T.StructType([f for f in SESSIONS.fields if f.name not in SESSION_PARENT_COLUMNS])

USERS = T.StructType([
    _field("userid", T.IntegerType()),
    _field("username", T.StringType()),
    _field("schemapath", T.StringType()),
    _field("cancreaterole", T.BooleanType()),
    _field("cancreatedb", T.BooleanType()),
    _field("autoinheritgrouppriv", T.BooleanType()),
    _field("connlimit", T.IntegerType()),
])

# Columns kept by the history only; the DBA maintains the last four by hand.
USER_BOOKKEEPING = T.StructType([
    _field("first_captured_time", T.TimestampNTZType()),
    _field("last_activity_time", T.TimestampNTZType()),
    _field("delete_time", T.TimestampNTZType()),
    _field("connect_revoked_time", T.TimestampNTZType()),
    _field("exempt_activity_flag", T.BooleanType()),
    _field("security_unique_id", T.LongType()),
    _field("email_address", T.StringType(), 200),
    _field("full_username", T.StringType(), 50),
])

USERS_HISTORY = T.StructType(USERS.fields + USER_BOOKKEEPING.fields)

# Columns the users sync copies from the source into the history.
USER_SOURCE_COLUMNS = [f.name for f in USERS.fields]
# Columns compared for change detection (username is the match key).
USER_COMPARED_COLUMNS = [c for c in USER_SOURCE_COLUMNS if c != "username"]
# Columns only a DBA edits.
USER_DBA_COLUMNS = ["connect_revoked_time", "exempt_activity_flag", "security_unique_id",
                    "email_address", "full_username"]

# Which name a userid had when (valid_to not included, null while it lasts).
USER_SPANS = T.StructType([
    _field("username", T.StringType()),
    _field("userid", T.IntegerType()),
    _field("valid_from", T.TimestampNTZType()),
    _field("valid_to", T.TimestampNTZType()),
])

# Durations of finished statements by the day they ended: a number and a
# mergeable quantile sketch for each database and user.
DURATION_SKETCHES = T.StructType([
    _field("dbname", T.StringType()),
    _field("username", T.StringType()),
    _field("day", T.DateType()),
    _field("n", T.LongType()),
    _field("sketch", T.BinaryType()),
])

RELATION_STATS = T.StructType([
    _field("owner_name", T.StringType()),
    _field("object_type", T.StringType()),
    _field("database", T.StringType()),
    _field("schema", T.StringType()),
    _field("relation", T.StringType()),
    _field("compression_level", T.StringType()),
    _field("uncompressed_size", T.LongType()),
])


@dataclass(frozen=True)
class Layout:
    """Physical intent of a table. The source database hash-distributes
    or replicates; in Spark that becomes the key of the merge exchange,
    a date partition column on disk, or a broadcast candidate."""

    key: str
    partition_by: str | None = None  # date column derived on write
    partition_source: str | None = None  # timestamp the date comes from
    replicated: bool = False  # small dimension: broadcast after a size check


LAYOUT = {
    "statements_new": Layout(key="statementid"),
    "statements_late": Layout(key="statementid"),
    "statements_history": Layout(key="statementid", partition_by="end_date", partition_source="endtime"),
    "sessions_new": Layout(key="sessionid", replicated=True),
    "sessions_history": Layout(key="sessionid", partition_by="start_date", partition_source="starttime"),
    "users_new": Layout(key="username", replicated=True),
    "users_history": Layout(key="username", replicated=True),
    "user_spans": Layout(key="username"),
    "duration_sketches": Layout(key="username", partition_by="end_date", partition_source="day"),
}

SCHEMAS = {
    "statements_new": STATEMENTS,
    "statements_late": STATEMENTS,
    "statements_history": STATEMENTS,
    "sessions_new": SESSIONS,
    "sessions_history": SESSIONS,
    "users_new": USERS,
    "users_history": USERS_HISTORY,
    "user_spans": USER_SPANS,
    "duration_sketches": DURATION_SKETCHES,
}


def typed_null(dtype: T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def align_schema(df: DataFrame, schema: T.StructType, *, strict: bool = True) -> DataFrame:
    """Bring ``df`` to ``schema``: columns bound by name, missing ones added
    as typed nulls (the 6.20 column upgrade), every column cast to its
    declared type. Extra columns (DBA additions) are kept at the end
    unless ``strict`` is set, in which case they are dropped."""
    present = set(df.columns)
    cols = [
        (F.col(f.name).cast(f.dataType) if f.name in present else typed_null(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    if not strict:
        declared = {f.name for f in schema.fields}
        cols += [F.col(c) for c in df.columns if c not in declared]
    return df.select(*cols)
