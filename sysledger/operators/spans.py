"""Validity spans of users, and joins of events with the span that was valid
at their time.

A span says that ``username`` was the name of ``userid`` from ``valid_from``
(included) to ``valid_to`` (not included; null while it lasts). A recreated
user is a new span with another id, a renamed one a new span with another name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import ts_literal
from ..plans.hints import fits_broadcast
from ..plans.skew import join_split
from ..schemas import USER_SPANS

SPAN_COLUMNS = USER_SPANS.fieldNames()


def spans_of(history: DataFrame) -> DataFrame:
    """The spans that a users history states: from the first capture to the
    deletion, one for each of its rows."""
    return history.where(F.col("username").isNotNull() & F.col("userid").isNotNull()).select(
        "username", "userid", F.col("first_captured_time").alias("valid_from"), F.col("delete_time").alias("valid_to"))


def advance_spans(spans: DataFrame, users_new: DataFrame, run_ts) -> DataFrame:
    """Spans after a run that saw the user list ``users_new``: an open span
    whose (username, userid) the list does not have ends now, and a pair of
    the list without an open span gets one that starts now. Closed spans never
    change. One full join on the pair: both sides are users, not events."""
    now = ts_literal(run_ts)
    pair = ["username", "userid"]
    open_ = spans.where(F.col("valid_to").isNull()).select(*pair, "valid_from")
    listed = users_new.where(F.col("username").isNotNull() & F.col("userid").isNotNull()).select(*pair).distinct()
    met = open_.withColumn("known", F.lit(True)).join(listed.withColumn("here", F.lit(True)), pair, "full")
    moved = met.select(
        *pair, F.when(F.col("known"), F.col("valid_from")).otherwise(now).alias("valid_from"),
        F.when(F.col("here").isNull(), now).alias("valid_to"))
    return spans.where(F.col("valid_to").isNotNull()).select(*SPAN_COLUMNS).unionByName(moved)


def disjoint_spans(spans: DataFrame) -> DataFrame:
    """Spans of a username cut where the next one starts, so that no time has
    two; of spans that start together the greatest userid stays. Spans without
    a start or name, and empty ones, go."""
    rows = spans.where(F.col("username").isNotNull() & F.col("valid_from").isNotNull())
    one = rows.groupBy("username", "valid_from").agg(F.max(F.struct("userid", F.col("valid_to").isNull().alias("lasts"), "valid_to")).alias("s"))
    following = F.lead("valid_from").over(Window.partitionBy("username").orderBy("valid_from"))
    cut = one.select("username", F.col("s.userid").alias("userid"), "valid_from", F.least("s.valid_to", following).alias("valid_to"))
    return cut.where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))


def _bucket(ts: Column, days: int) -> Column:
    return F.floor(F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")) / days)


def as_of(events: DataFrame, name_col: str, ts_col: str, spans: DataFrame, spread_by: str, *, bucket_days: int = 30,
          max_broadcast_bytes: int | None = None) -> DataFrame:
    """``events`` left-joined with the span of ``name_col`` valid at ``ts_col``:
    adds userid, valid_from, valid_to (null where there is none).

    Spans of measured size within the broadcast budget meet the events without
    a shuffle. Larger ones are dealt, like the events, to buckets of
    ``bucket_days``, clipped to the time the events cover, so a name's events
    are spread over time; a name and bucket that still holds a large share of
    all events is split further by ``spread_by`` (``plans.skew``)."""
    side = disjoint_spans(spans).select(F.col("username").alias(name_col), "userid", "valid_from", "valid_to")
    inside = (F.col("valid_from") <= F.col(ts_col)) & (F.col("valid_to").isNull() | (F.col(ts_col) < F.col("valid_to")))
    options = {} if max_broadcast_bytes is None else {"max_bytes": max_broadcast_bytes}
    columns = [*events.columns, "userid", "valid_from", "valid_to"]
    if fits_broadcast(side, **options):
        right = side.withColumnRenamed(name_col, "__name")
        return events.join(F.broadcast(right), (F.col(name_col) == F.col("__name")) & inside, "left").select(*columns)
    covered = events.agg(F.min(ts_col).alias("lo"), F.max(ts_col).alias("hi")).first()
    if covered.lo is None:  # no event has a time
        return events.select("*", *[F.lit(None).cast(USER_SPANS[c].dataType).alias(c) for c in ("userid", "valid_from", "valid_to")])
    low, high = (ts_literal(t) for t in covered)
    last = F.least(F.coalesce("valid_to", high), high)
    dealt = side.where((F.col("valid_from") <= high) & (last >= low)).withColumn(
        "__bucket", F.explode(F.sequence(_bucket(F.greatest("valid_from", low), bucket_days), _bucket(last, bucket_days))))
    return join_split(events.withColumn("__bucket", _bucket(F.col(ts_col), bucket_days)), dealt, [name_col, "__bucket"], spread_by,
                      condition=inside).select(*columns)


def attribute_as_of(statements: DataFrame, sessions: DataFrame, spans: DataFrame, **options) -> DataFrame:
    """Each statement with its session's user and the userid that this name
    belonged to when the statement started, dropped and recreated users
    included. ``user_dropped``: the span has ended since; ``name_now``: the
    latest name of that userid (a renamed user's present one)."""
    session = sessions.select("sessionid", "username", "dbname")
    rows = statements.select("statementid", "sessionid", "starttime", "endtime")
    named = join_split(rows, session, ["sessionid"], "statementid")
    # statements without a user match nothing and need not be dealt by name
    found = as_of(named.where(F.col("username").isNotNull()), "username", "starttime", spans, "statementid", **options)
    lost = named.where(F.col("username").isNull()).select(
        "*", *[F.lit(None).cast(USER_SPANS[c].dataType).alias(c) for c in ("userid", "valid_from", "valid_to")])
    latest = spans.where("userid is not null").groupBy("userid").agg(F.max(F.struct("valid_from", "username")).alias("l")).select(
        "userid", F.col("l.username").alias("name_now"))
    out = join_split(found.unionByName(lost), latest, ["userid"], "statementid")
    return out.select("statementid", "sessionid", "username", "dbname", "userid", "name_now",
                      F.when(F.col("userid").isNotNull(), F.col("valid_to").isNotNull()).alias("user_dropped"), "starttime", "endtime")
