"""Staging and history tables as plain parquet folders below one shared root.

    <root>/<table>_new/            staging: replaced by each run
    <root>/<table>/<part>=.../     published tables, partitioned
    <root>/<table>_next/           the partitions that a run is about to replace
    <root>/run_log/job=<job>/      what the runs did

A merge or a replacement first writes the new content of the partitions it
touches to ``<table>_next`` and then publishes them with Spark's own writer in
dynamic partition overwrite: other partitions are not opened. Tables are
independent of each other, so jobs on different tables may overlap in any way;
two runs that write the same table must not overlap.

Publishing only copies ``<table>_next``, so it can be repeated. The log says
which staged content has not been published; the next run on that table
publishes it first (``recover``), so a driver lost between the two writes, or in
the middle of publishing, loses nothing. There is no publication of several
tables at once: each is complete in itself.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import EMPTY_HISTORY_WATERMARK
from ..operators.capture import staged_keys, watermark_value
from ..plans.hints import max_broadcast_rows
from ..schemas import LAYOUT, SCHEMAS, align_schema
from ..session import checkpoint_dir

NULL_PART = "__HIVE_DEFAULT_PARTITION__"
# Tables without a date are one partition; they are replaced as a whole.
WHOLE, WHOLE_COLUMN = "all", "part"

LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("step", T.StringType()),
    T.StructField("run_ts", T.TimestampNTZType()),
    T.StructField("low", T.TimestampNTZType()),
    T.StructField("high", T.TimestampNTZType()),
    T.StructField("extracted", T.LongType()),
    T.StructField("inserted", T.LongType()),
    T.StructField("updated", T.LongType()),
    # of the steps 'staged' and 'published'; of 'seen' the runs are the parts
    T.StructField("table", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("parts", T.ArrayType(T.StringType())),
])
STAGING = {"statements_new", "statements_late", "sessions_new", "users_new"}
STAGED, PUBLISHED, SEEN = "staged", "published", "seen"
# How far before the run the newest rows of a history are looked for first.
RECENT_DAYS = 30


def default_root(spark: SparkSession, name: str = "sysledger_tables") -> str:
    """Root of the tables inside the cluster's shared checkpoint folder."""
    base = checkpoint_dir(spark)
    if not base:
        raise ValueError("no spark.checkpoint.dir: pass an explicit shared root")
    return f"{base.rstrip('/')}/{name}"


def as_time(value) -> dt.datetime | None:
    return value if value is None or isinstance(value, dt.datetime) else dt.datetime.fromisoformat(str(value))


@dataclass
class RunLog:
    job: str
    step: str
    run_ts: dt.datetime | None
    low: dt.datetime | None = None
    high: dt.datetime | None = None
    extracted: int | None = None
    inserted: int | None = None
    updated: int | None = None


@dataclass
class Staged:
    """Content of a table that waits in ``<table>_next``."""

    table: str
    job: str
    rows: int
    parts: list[str]  # every partition to replace
    emptied: list[str]  # those of them that get no row
    counts: dict[str, int] = field(default_factory=dict)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)


class Tables:
    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- layout ---------------------------------------------------------------
    @staticmethod
    def part_of(name: str) -> tuple[str, Column, T.DataType]:
        """Partition column of a published table, its value and its type."""
        layout = LAYOUT[name]
        if layout.partition_by:
            return layout.partition_by, F.to_date(F.col(layout.partition_source)), T.DateType()
        return WHOLE_COLUMN, F.lit(WHOLE), T.StringType()

    def _read(self, spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            # not written yet: empty. Any other fault of a read is raised.
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def _with_part(self, spark: SparkSession, name: str, path: str) -> DataFrame:
        column, _, kind = self.part_of(name)
        return self._read(spark, path, T.StructType([*SCHEMAS[name].fields, T.StructField(column, kind)]))

    # --- reads ----------------------------------------------------------------
    def read(self, spark: SparkSession, name: str, parts: list[str] | None = None, since=None, since_col: str | None = None) -> DataFrame:
        """The table; optionally only some partitions, or, for a reach-back
        bound ``since_col > since`` on the column it is partitioned by, only
        those that can hold such rows (rows still need the exact filter). A
        bound on another column prunes nothing. Partitions are pruned by Spark."""
        if name in STAGING:
            return self._read(spark, self.path(name), SCHEMAS[name])
        column, _, _ = self.part_of(name)
        df = self._with_part(spark, name, self.path(name))
        if parts is not None:
            df = df.where(self._in_parts(name, parts))
        source = LAYOUT[name].partition_source
        if since is not None and source and (since_col or source) == source:
            df = df.where(F.col(column) >= F.lit(as_time(since).date()))
        return df.select(*SCHEMAS[name].fieldNames())

    def _in_parts(self, name: str, parts: list[str]) -> Column:
        column, _, kind = self.part_of(name)
        found = F.col(column).isin([F.lit(p).cast(kind) for p in parts if p != NULL_PART]) if set(parts) - {NULL_PART} else F.lit(False)
        return (found | F.col(column).isNull()) if NULL_PART in parts else found

    def watermark(self, spark: SparkSession, name: str, run_ts) -> dt.datetime:
        """max(time) of a history cut to seconds, 2000-01-01 for an empty one.
        The newest partitions are tried first: a row newer than all of theirs
        would be one of theirs."""
        source = LAYOUT[name].partition_source
        recent = self.read(spark, name, since=as_time(run_ts) - dt.timedelta(days=RECENT_DAYS))
        found = watermark_value(recent, source)
        if found > as_time(EMPTY_HISTORY_WATERMARK):
            return found
        return watermark_value(self.read(spark, name), source)

    # --- writes -----------------------------------------------------------------
    def replace_staging(self, spark: SparkSession, name: str, df: DataFrame) -> DataFrame:
        """Full replacement of a staging table, read back."""
        align_schema(df, SCHEMAS[name]).write.mode("overwrite").parquet(self.path(name))
        return self.read(spark, name)

    def seed(self, spark: SparkSession, name: str, df: DataFrame) -> None:
        """First content of a published table, in one write."""
        if name in STAGING:
            self.replace_staging(spark, name, df)
            return
        column, value, _ = self.part_of(name)
        self._sorted(name, align_schema(df, SCHEMAS[name]).withColumn(column, value)).write.partitionBy(column).parquet(self.path(name))

    def _sorted(self, name: str, df: DataFrame) -> DataFrame:
        # no exchange: the order that the writer needs, and narrow key ranges
        # in each file, so that a merge's range filter skips row groups
        return df.sortWithinPartitions(self.part_of(name)[0], LAYOUT[name].key)

    def _stage(self, spark: SparkSession, name: str, job: str, df: DataFrame, parts: list[str] | None) -> Staged:
        """Write ``df`` (columns of the table, more are allowed) as the next
        content of ``parts`` and of the partitions that it has rows in."""
        column, value, _ = self.part_of(name)
        extra = [c for c in df.columns if c not in SCHEMAS[name].fieldNames()]
        out = align_schema(df, SCHEMAS[name], strict=not extra).withColumn(column, value)
        self._sorted(name, out).write.mode("overwrite").partitionBy(column).parquet(self.path(f"{name}_next"))
        found = self._next_parts(spark, name)
        touched = {*(parts or []), *found}
        staged = Staged(name, job, sum(found.values()), sorted(touched), sorted(touched - set(found)))
        self._log(spark, job, [(staged.run_id, STAGED, None, None, None, None, None, None, name, staged.rows, staged.parts)])
        return staged

    def _next_parts(self, spark: SparkSession, name: str) -> dict[str, int]:
        """Partition -> rows of the staged content, a row a date."""
        text = F.coalesce(F.col(self.part_of(name)[0]).cast("string"), F.lit(NULL_PART))
        found = self._with_part(spark, name, self.path(f"{name}_next")).groupBy(text.alias("p")).count().collect()
        return {r["p"]: r["count"] for r in found}

    def stage_replacement(self, spark: SparkSession, name: str, df: DataFrame, job: str, parts: list[str] | None = None) -> Staged:
        """Next content of the whole table, or of ``parts`` of it."""
        if parts is None:
            column, _, _ = self.part_of(name)
            text = F.coalesce(F.col(column).cast("string"), F.lit(NULL_PART))
            now = self._with_part(spark, name, self.path(name)).select(text.alias("p")).distinct().collect()
            parts = [r.p for r in now]
        return self._stage(spark, name, job, df, parts)

    def next_rows(self, spark: SparkSession, staged: Staged, extra: T.StructType) -> DataFrame:
        """Staged content with the extra columns that were written with it."""
        return self._read(spark, self.path(f"{staged.table}_next"), T.StructType([*SCHEMAS[staged.table].fields, *extra.fields]))

    def stage_merge(self, spark: SparkSession, name: str, new: DataFrame, job: str) -> Staged:
        """Upsert of ``new`` (a written table) by the key of ``name``: the next
        content of the partitions that hold a key of ``new`` or get a row of
        it. Counts: extracted, inserted, updated."""
        layout = LAYOUT[name]
        key, (column, value, _) = layout.key, self.part_of(name)
        text = F.coalesce(F.col(column).cast("string"), F.lit(NULL_PART))
        keys = staged_keys(new, key)
        b = new.withColumn(column, value).agg(
            F.min(key).alias("lo"), F.max(key).alias("hi"), F.count(F.lit(1)).alias("n"), F.collect_set(text).alias("parts")).first()
        # the keys are no more than the rows just counted: proof of their size
        small = F.broadcast(keys) if b.n <= max_broadcast_rows(keys) else keys
        history = self._with_part(spark, name, self.path(name))
        # the key range skips files and row groups by their minima and maxima
        held = history.where(F.col(key).between(F.lit(b.lo), F.lit(b.hi))).select(key, text.alias("p")).join(small, key, "left_semi")
        held = held.groupBy(key, "p").agg(F.count(F.lit(1)).alias("c"))
        first = held.groupBy(key).agg(F.min("p").alias("first"))
        hit = held.join(first, key).groupBy("p").agg(F.sum("c").alias("rows"), F.sum((F.col("p") == F.col("first")).cast("long")).alias("keys")).collect()
        touched = sorted({*b.parts, *(r.p for r in hit)})
        kept = history.where(self._in_parts(name, touched)).join(small, key, "left_anti")
        fields = SCHEMAS[name].fieldNames()
        staged = self._stage(spark, name, job, kept.select(*fields).unionByName(new.select(*fields)), touched)
        staged.counts = {"extracted": b.n, "inserted": b.n - sum(r["keys"] for r in hit), "updated": sum(r["rows"] for r in hit)}
        return staged

    def publish(self, spark: SparkSession, staged: Staged, entries: list[RunLog] = ()) -> None:
        """Replace the staged partitions, and only these, by their next
        content; log the run. Repeating it changes nothing."""
        name = staged.table
        column, _, _ = self.part_of(name)
        rows = self._with_part(spark, name, self.path(f"{name}_next"))
        (self._sorted(name, rows).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(column).parquet(self.path(name)))
        for part in staged.emptied:  # these get no file by that
            spark.createDataFrame([], SCHEMAS[name]).write.mode("overwrite").parquet(f"{self.path(name)}/{column}={part}")
        done = {staged.job: [(staged.run_id, PUBLISHED, None, None, None, None, None, None, name, staged.rows, staged.parts)]}
        for e in entries:
            done.setdefault(e.job, []).append((staged.run_id, e.step, as_time(e.run_ts), as_time(e.low), as_time(e.high), e.extracted,
                                               e.inserted, e.updated, None, None, None))
        for job, rows in done.items():
            self._log(spark, job, rows)

    def recover(self, spark: SparkSession, *names: str) -> bool:
        """Publish what runs of the past staged for these tables and did not
        publish; whether there was any."""
        log = self._read(spark, self.path("run_log"), T.StructType([*LOG.fields, T.StructField("job", T.StringType())]))
        of = log.where(F.col("table").isin(*names) & F.col("step").isin(STAGED, PUBLISHED))
        open_ = of.groupBy("run_id", "table").agg(F.first("job").alias("job"), F.max("rows").alias("rows"), F.first("parts").alias("parts"),
                                                  F.max((F.col("step") == PUBLISHED).cast("int")).alias("done")).where("done = 0").collect()
        for r in open_:
            found = self._next_parts(spark, r.table)
            # content that a later run has begun to replace is not there any more
            if sum(found.values()) == r.rows and set(found) <= set(r.parts):
                self.publish(spark, Staged(r.table, r.job, r.rows, list(r.parts), sorted(set(r.parts) - set(found)), run_id=r.run_id))
        return bool(open_)

    # --- log --------------------------------------------------------------------
    def unseen(self, spark: SparkSession, name: str, job: str) -> tuple[list[str], list[str]]:
        """Runs that published partitions of ``name`` and that ``job`` has not
        marked as seen, and those partitions."""
        log = self._read(spark, self.path("run_log"), T.StructType([*LOG.fields, T.StructField("job", T.StringType())]))
        runs = log.where((F.col("table") == name) & (F.col("step") == PUBLISHED)).select("run_id", "parts")
        seen = log.where((F.col("job") == job) & (F.col("step") == SEEN)).select(F.explode("parts").alias("run_id"))
        found = runs.join(seen, "run_id", "left_anti").collect()  # a row a run
        return sorted(r.run_id for r in found), sorted({p for r in found for p in r.parts})

    def mark_seen(self, spark: SparkSession, job: str, runs: list[str]) -> None:
        if runs:
            self._log(spark, job, [(uuid.uuid4().hex, SEEN, None, None, None, None, None, None, None, None, runs)])

    def _log(self, spark: SparkSession, job: str, rows: list[tuple]) -> None:
        # a folder for each job: appends of jobs that overlap do not meet
        spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(self.path(f"run_log/job={job}"))

    def run_log(self, spark: SparkSession) -> DataFrame:
        """The steps of all runs (job, step, bounds, counts)."""
        log = self._read(spark, self.path("run_log"), T.StructType([*LOG.fields, T.StructField("job", T.StringType())]))
        return log.where(~F.col("step").isin(STAGED, PUBLISHED, SEEN)).select("job", "step", "run_ts", "low", "high", "extracted", "inserted", "updated")
