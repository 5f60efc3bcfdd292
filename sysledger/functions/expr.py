"""Scalar expressions and predicates of the catalog jobs.

All of them are built-in Column expressions (JVM side, codegen'd); no
Python runs per row. Times are ``timestamp_ntz`` throughout, built so
that the session time zone never changes a value.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_NTZ = "timestamp_ntz"

# Default watermark for an empty history (fixed value of the jobs).
EMPTY_HISTORY_WATERMARK = "2000-01-01 00:00:00"

# Display format of times in the job output: MM/DD/YYYY HH24:MI:SS.
DISPLAY_FORMAT = "MM/dd/yyyy HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value: str | dt.datetime | Column) -> Column:
    """A timestamp_ntz literal from text ('2024-01-25 00:00:00.5') or a
    naive datetime. Cast from text is independent of the session zone."""
    if isinstance(value, Column):
        return value.cast(TS_NTZ)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            raise ValueError("run times are wall-clock (naive) datetimes")
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(TS_NTZ)


def to_second(c: Column | str) -> Column:
    """Cut a timestamp_ntz to whole seconds (truncation, never rounding).

    Rebuilt from its fields, so no zone conversion can move the value
    (``date_trunc`` goes through the session zone and returns a zoned
    timestamp)."""
    c = _col(c)
    return F.make_timestamp_ntz(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c), F.second(c))


def format_second(c: Column | str) -> Column:
    """Text form MM/DD/YYYY HH24:MI:SS of a time (for reports)."""
    return F.date_format(_col(c), DISPLAY_FORMAT)


def parse_second(c: Column | str) -> Column:
    """Inverse of ``format_second``."""
    return F.to_timestamp_ntz(_col(c), F.lit(DISPLAY_FORMAT))


# Text accepted as boolean input by the source database (fixed values;
# compared after trim and lower-case).
BOOL_TRUE_TEXT = ["t", "true", "y", "yes", "on", "1"]
BOOL_FALSE_TEXT = ["f", "false", "n", "no", "off", "0"]


def to_bool(c: Column | str, name: str | None = None) -> Column:
    """Text -> boolean as the source database casts it. Bad text fails the
    job with a clear message instead of turning into null, whatever the
    session's ANSI setting."""
    c = _col(c)
    label = name or "value"
    t = F.lower(F.trim(c.cast("string")))
    return (
        F.when(c.isNull(), F.lit(None).cast("boolean"))
        .when(t.isin(BOOL_TRUE_TEXT), F.lit(True))
        .when(t.isin(BOOL_FALSE_TEXT), F.lit(False))
        .otherwise(F.raise_error(F.concat(F.lit(f"invalid boolean text in {label}: "), c.cast("string"))).cast("boolean"))
    )


_MB = 1024 * 1024
# the largest size that rounds to 99,999,999.999999 MB
_MOST_BYTES = (10**14 * _MB - _MB // 2 - 1) // 10**6


def bytes_to_mb(c: Column | str) -> Column:
    """bytes / (1024*1024) as decimal(14,6), rounded once, half up.

    ``round(s * 10^6 / 2^20)`` is computed as an integer division in
    decimal(38,0), so sums beyond the bigint range stay exact; a result
    above 99,999,999.999999 fails by itself, whatever the session's settings
    say about overflow."""
    s = _col(c).cast("decimal(38,0)")
    scaled = s * F.lit(1_000_000).cast("decimal(38,0)") + F.lit(_MB // 2).cast("decimal(38,0)")
    micros = F.floor(scaled / F.lit(_MB).cast("decimal(38,0)"))
    mb = (micros.cast("decimal(38,0)") * F.lit(Decimal("0.000001"))).cast("decimal(14,6)")
    too_large = F.abs(s) > F.lit(_MOST_BYTES).cast("decimal(38,0)")
    lost = _col(c).isNotNull() & (s.isNull() | too_large)
    return F.when(lost, F.raise_error(F.concat(F.lit("size does not fit decimal(14,6): "), _col(c).cast("string"))).cast("decimal(14,6)")).otherwise(mb)


def object_label(c: Column | str) -> Column:
    """Report label: relations are shown as 'table', other types as is."""
    c = _col(c)
    return F.when(c == F.lit("relation"), F.lit("table")).otherwise(c)


# Schema-name pattern of temporary schemas (fixed value). '_' is a
# one-character wildcard, as in the catalog scripts.
TEMP_SCHEMA_PATTERN = "nc_temp%"
SYSTEM_SCHEMA = "nc_system"


def not_temp_schema(c: Column | str = "schemaname") -> Column:
    """schemaname not like 'nc_temp%' (a null name does not pass)."""
    return ~_col(c).like(TEMP_SCHEMA_PATTERN)


def open_interval(c: Column | str, low: Column, high: Column) -> Column:
    """low < c < high, strict on both ends; null times never pass."""
    c = _col(c)
    return (c > low) & (c < high)


def differs(a: Column, b: Column) -> Column:
    """``a != b`` with the update's three-valued logic: a comparison with
    null is unknown, so null-to-value changes alone are not a change."""
    return F.coalesce(a != b, F.lit(False))


def any_true(cols: list[Column]) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | c
    return out
