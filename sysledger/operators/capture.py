"""Incremental capture of short-lived system tables into permanent history:
watermark, windowed extract, upsert by key, and the run's counts.

Scale notes. The history grows without bound while one night's staging is
small, so every step is shaped around the staged keys:
- the watermark is one aggregate (``max``), partial per partition;
- the window is a filter with literal bounds, pushed to the source scan;
- the merge scans the history once and drops rows whose key was staged
  through a broadcast of the staged keys (when they fit; otherwise a
  shuffled anti-join), then appends the staged rows. No history row is
  shuffled on the broadcast path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import EMPTY_HISTORY_WATERMARK, open_interval, to_bool, to_second, ts_literal
from ..plans.hints import broadcast_if_small, max_broadcast_rows
from ..schemas import SESSIONS, STATEMENTS, USERS, align_schema


def watermark(history: DataFrame, ts_col: str, default: str = EMPTY_HISTORY_WATERMARK) -> DataFrame:
    """One row: the latest ``ts_col`` of the history cut to whole seconds,
    or ``default`` when the history is empty (or all null)."""
    return history.agg(F.coalesce(to_second(F.max(ts_col)), ts_literal(default)).alias("watermark"))


def upper_bound(run_ts) -> Column:
    """Upper end of the window: the run time cut to whole seconds."""
    return to_second(ts_literal(run_ts))


def watermark_value(history: DataFrame, ts_col: str, default: str = EMPTY_HISTORY_WATERMARK):
    """The watermark as a driver-side scalar (one value), so the extract
    filter is a literal that reaches the source scan and its partitions."""
    return watermark(history, ts_col, default).first()[0]


def extract_window(source: DataFrame, ts_col: str, low, high) -> DataFrame:
    """Rows with ``low < ts_col < high``. ``low``/``high`` are literals,
    datetimes or Columns (a scalar subquery is allowed)."""
    low_c = low if isinstance(low, Column) else ts_literal(low)
    high_c = high if isinstance(high, Column) else ts_literal(high)
    return source.where(open_interval(ts_col, low_c, high_c))


def typed_statements(rows: DataFrame) -> DataFrame:
    """Statement rows typed for staging (``iscancelable`` arrives as text)."""
    return align_schema(rows.withColumn("iscancelable", to_bool("iscancelable", "iscancelable")), STATEMENTS)


def extract_statements(source: DataFrame, low, high) -> DataFrame:
    """Statements that ended inside the window, typed for staging."""
    return typed_statements(extract_window(source, "endtime", low, high))


# Status of every captured session (fixed value).
SESSION_STATUS = "PASSED"


def extract_sessions(source: DataFrame, low, high) -> DataFrame:
    """Sessions that started inside the window, with their status."""
    rows = extract_window(source, "starttime", low, high)
    return align_schema(rows.withColumn("status", F.lit(SESSION_STATUS)), SESSIONS)


def extract_users(source: DataFrame) -> DataFrame:
    """All current users, typed for staging (three booleans as text)."""
    cast = {c: to_bool(c, c) for c in ("cancreaterole", "cancreatedb", "autoinheritgrouppriv")}
    return align_schema(source.withColumns(cast), USERS)


def staged_keys(staged: DataFrame, key: str, *, check_unique: bool = True) -> DataFrame:
    """Distinct non-null staged keys. With ``check_unique`` a key staged
    twice fails the plan: the outcome of a merge would depend on row order."""
    keys = staged.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    if check_unique:
        message = F.concat(F.lit(f"duplicate staged {key}: "), F.col(key).cast("string"))
        keys = keys.where(F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.lit(True)))
    return keys.select(key)


def latest_per_key(staged: DataFrame, key: str, order_col: str) -> DataFrame:
    """Keep one staged row per key: the greatest ``order_col`` (ties broken
    by the remaining columns, so the choice is deterministic). Aggregated
    with partial aggregation, so a hot key stays cheap."""
    others = [c for c in staged.columns if c not in (key, order_col)]
    best = F.max(F.struct(F.col(order_col), *[F.col(c) for c in others])).alias("_row")
    picked = staged.where(F.col(key).isNotNull()).groupBy(key).agg(best)
    nulls = staged.where(F.col(key).isNull())
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in [order_col, *others]]).select(*staged.columns) \
        .unionByName(nulls)


def merge_upsert(history: DataFrame, staged: DataFrame, key: str, *, check_unique: bool = True,
                 dedupe_by: str | None = None) -> DataFrame:
    """MERGE staged INTO history ON key: matched rows take every staged
    column, unmatched staged rows are inserted.

    Both merges of the jobs overwrite all non-key columns, so the merge is
    ``history`` minus the staged keys, plus the staged rows. Null keys never
    match (history rows with a null key stay, staged ones are inserted).

    ``staged`` is evaluated twice (key count for the broadcast check, then
    the merge): stage an expensive source first, as the jobs do. This form
    rewrites the whole history; ``Tables.stage_merge`` rewrites only the
    partitions that hold staged keys."""
    if dedupe_by:
        staged = latest_per_key(staged, key, dedupe_by)
        check_unique = False
    keys = staged_keys(staged, key, check_unique=check_unique)
    kept = history.join(broadcast_if_small(keys), key, "left_anti")
    return append_rows(kept, staged)


def missed_rows(source: DataFrame, history: DataFrame, key: str, ts_col: str, watermark) -> DataFrame:
    """Source rows at or below the ``watermark`` whose key the history does not
    hold: they became visible after the window that should have had them, and
    no later window will. (A row whose time is null waits; one without a key
    cannot be looked up.)

    The source keeps some days, the history years: so the late rows' keys go to
    the history, not the other way. Their range skips files and row groups,
    then a semi-join keeps the keys that are there: with a broadcast of the
    late keys if their count allows it, else shuffled, where Spark itself puts
    a Bloom filter of the smaller side on the history's scan. Only keys that are
    in both sides reach the anti-join."""
    late = source.where((F.col(ts_col) <= ts_literal(watermark)) & F.col(key).isNotNull())
    keys = late.select(key).distinct()
    b = late.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    side = F.broadcast if b.n <= max_broadcast_rows(keys) else (lambda df: df)
    held = history.where(F.col(key).between(F.lit(b.lo), F.lit(b.hi))).select(key).join(side(keys), key, "left_semi").distinct()
    return late.join(side(held), key, "left_anti")


def merge_counts(history: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """One row: rows extracted (staged), inserted and updated by the merge.

    ``updated`` counts history rows whose key was staged; ``inserted`` the
    staged rows that match none. The history side contributes only its key
    column, filtered by the (broadcast) staged keys before the exchange, so
    the shuffle is bounded by the staging size."""
    keys = staged_keys(staged, key, check_unique=False)
    hit = history.select(key).join(broadcast_if_small(keys), key, "left_semi")
    tagged = (
        staged.select(key, F.lit(1).alias("_s"), F.lit(0).alias("_h"))
        .unionByName(hit.select(key, F.lit(0).alias("_s"), F.lit(1).alias("_h")))
    )
    per_key = tagged.groupBy(key).agg(F.sum("_s").alias("_s"), F.sum("_h").alias("_h"))
    return per_key.agg(
        F.coalesce(F.sum("_s"), F.lit(0)).cast("bigint").alias("extracted"),
        F.coalesce(F.sum(F.when(F.col("_h") == 0, F.col("_s")).otherwise(F.lit(0))), F.lit(0)).cast("bigint").alias("inserted"),
        F.coalesce(F.sum("_h"), F.lit(0)).cast("bigint").alias("updated"),
    )


def append_rows(history: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT INTO history SELECT ...: rows bound to the history's columns
    by name (never by position), appended without a shuffle."""
    return history.unionByName(rows.select(*history.columns))


def extract_count(df: DataFrame) -> DataFrame:
    """One row: number of rows (the extract count of a window)."""
    return df.agg(F.count(F.lit(1)).alias("extracted"))
