"""Extract from the live database over JDBC, with the window pushed down.

The catalog jobs pull only the rows of one window from the source's
system tables. Here the window becomes the ``dbtable`` subquery (so the
source filters before sending) and the read is split into parallel range
queries of about as many rows each, whatever the column's distribution.
Credentials come only through ``properties`` (never logged here).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def _sql_ts(value) -> str:
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    text = str(value)
    if "'" in text:
        raise ValueError("timestamp bound must not contain quotes")
    # JDBC escape syntax: every JDBC driver translates it to its dialect
    return "{ts '" + text + "'}"


def window_query(table: str, columns: list[str] | str, ts_col: str, low, high) -> str:
    """``select <columns> from <table> where low < ts_col < high``."""
    cols = columns if isinstance(columns, str) else ", ".join(columns)
    return f"SELECT {cols} FROM {table} WHERE {ts_col} > {_sql_ts(low)} AND {ts_col} < {_sql_ts(high)}"


def read_remote(spark: SparkSession, url: str, query: str, *, properties: dict[str, str] | None = None,
                partition_column: str | None = None, lower_bound=None, upper_bound=None,
                num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Rows of ``query`` on the database at ``url``.

    With ``partition_column`` (numeric, date or timestamp) and bounds, Spark
    issues ``num_partitions`` range queries in parallel; the bounds only
    decide the split, every row of ``query`` is read."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", f"({query}) extract_q")
        .option("fetchsize", str(fetch_size))
        .option("preferTimestampNTZ", "true")
    )
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions))
        )
    return reader.load()


def column_name(spark: SparkSession, url: str, table: str, column: str, properties: dict[str, str] | None = None) -> str:
    """``column`` as the database spells it, quoted its way: databases fold
    the case of bare names differently. Only the table's schema is fetched."""
    names = read_remote(spark, url, f"SELECT * FROM {table}", properties=properties).columns
    found = next((n for n in names if n == column), None) or next((n for n in names if n.lower() == column.lower()), None)
    if found is None:
        raise ValueError(f"{table} has no column {column}; it has {', '.join(names)}")
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(found)


# Intervals that one histogram query counts.
HISTOGRAM = 512


def _literal(value) -> str:
    return _sql_ts(value) if isinstance(value, dt.datetime) else str(int(value))


def _steps(column: str, low) -> str:
    """SQL: whole units (seconds or keys) of ``column`` above ``low``."""
    if isinstance(low, dt.datetime):
        return f"{{fn TIMESTAMPDIFF(SQL_TSI_SECOND, {_sql_ts(low)}, {column})}}"
    return f"({column} - {_literal(low)})"


def _plus(low, steps: int):
    return low + dt.timedelta(seconds=steps) if isinstance(low, dt.datetime) else low + steps


def _histogram(spark: SparkSession, url: str, query: str, column: str, low, steps: int, total: int, most: int, properties) -> list[tuple]:
    """(start, rows) of intervals from ``low`` over ``steps`` units, in order;
    intervals of more than ``most`` rows are counted again in finer ones."""
    width = max(1, -(-steps // HISTOGRAM))
    inside = f"{column} >= {_literal(low)} AND {column} < {_literal(_plus(low, steps))}"
    counted = read_remote(spark, url, f"SELECT B, COUNT(*) AS N FROM (SELECT {_steps(column, low)} / {width} AS B FROM ({query}) window_rows "
                                      f"WHERE {inside}) numbered GROUP BY B", properties=properties)
    out = []
    for b, n in sorted((int(r[0]), int(r[1])) for r in counted.collect()):  # at most HISTOGRAM rows
        start = _plus(low, b * width)
        if n > most and width > 1:
            out += _histogram(spark, url, query, column, start, min(width, steps - b * width), n, most, properties)
        else:
            out.append((start, n))
    return out


def split_predicates(spark: SparkSession, url: str, query: str, column: str, parts: int, *, properties: dict[str, str] | None = None) -> list[str]:
    """Up to ``parts`` predicates on ``column`` (whole numbers or times) that
    cut the rows of ``query`` into about equally many rows each, every row in
    exactly one (nulls in the first).

    The database counts rows in at most ``HISTOGRAM`` intervals between the
    column's bounds, and again inside intervals that hold too much, so a range
    with most of the rows in one place is cut there. Only a single key or
    second cannot be cut. What comes back are counts, never rows."""
    bounds = read_remote(spark, url, f"SELECT MIN({column}) AS LO, MAX({column}) AS HI, COUNT(*) AS N FROM ({query}) window_rows",
                         properties=properties).first()
    low, high, total = bounds[0], bounds[1], int(bounds[2])
    parts = min(parts, total)
    if low is None or parts < 2:
        return []
    if isinstance(low, dt.datetime):
        low = low.replace(microsecond=0)
        steps = int((high - low).total_seconds()) + 1
    else:
        low, steps = int(low), int(high) - int(low) + 1
    target = total / parts
    points, held, cuts = [], 0, 1
    for start, n in _histogram(spark, url, query, column, low, steps, total, max(1, int(target / 8)), properties):
        # cut where the rows so far are nearest to the next share
        if held and held + n / 2 > cuts * target and cuts < parts:
            points.append(start)
            cuts = max(cuts + 1, int(held / target) + 1)
        held += n
    if not points:
        return []
    first = f"{column} < {_literal(points[0])} OR {column} IS NULL"
    middle = [f"{column} >= {_literal(a)} AND {column} < {_literal(b)}" for a, b in zip(points, points[1:], strict=False)]
    return [first, *middle, f"{column} >= {_literal(points[-1])}"]


def read_split(spark: SparkSession, url: str, query: str, column: str, parts: int, *, properties: dict[str, str] | None = None,
               fetch_size: int = 10_000) -> DataFrame:
    """Rows of ``query``, read by one database query for each of the even
    ``split_predicates``; columns in lower case."""
    predicates = split_predicates(spark, url, query, column, parts, properties=properties)
    if predicates:
        options = {"fetchsize": str(fetch_size), "preferTimestampNTZ": "true", **(properties or {})}
        df = spark.read.jdbc(url, f"({query}) extract_q", predicates=predicates, properties=options)
    else:
        df = read_remote(spark, url, query, properties=properties, fetch_size=fetch_size)
    return df.toDF(*[c.lower() for c in df.columns])


def windowed_source(spark: SparkSession, url: str, table: str, ts_col: str, *, properties: dict[str, str] | None = None,
                    partition_column: str | None = None, num_partitions: int = 8):
    """A source for the capture jobs: ``(low, high) -> DataFrame`` reading
    only the window's rows, as ``num_partitions`` queries of about as many rows
    each: by the window's own time column, or by ``partition_column``."""
    def make(low, high) -> DataFrame:
        time = column_name(spark, url, table, ts_col, properties)
        by = column_name(spark, url, table, partition_column, properties) if partition_column else time
        return read_split(spark, url, window_query(table, "*", time, low, high), by, num_partitions, properties=properties)
    return make
