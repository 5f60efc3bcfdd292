"""Scalar semantics: second truncation (D1), open window (D3), change test
(D4), boolean text (D8), MB rounding and range (D9), temp-schema pattern
(D10), null ordering of the size report (D11)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sysledger.functions import expr as X


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_to_second_truncates_not_rounds(spark):
    v = one(spark, X.to_second(X.ts_literal("2024-01-14 23:57:51.999999")))
    assert v == dt.datetime(2024, 1, 14, 23, 57, 51)


def test_to_second_is_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        # 02:30 does not exist on this day in New York (DST gap)
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        v = one(spark, X.to_second(X.ts_literal("2024-03-10 02:30:15.7")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert v == dt.datetime(2024, 3, 10, 2, 30, 15)


def test_format_and_parse_round_trip(spark):
    ts = X.ts_literal("2024-01-05 07:08:09.5")
    assert one(spark, X.format_second(ts)) == "01/05/2024 07:08:09"
    assert one(spark, X.parse_second(X.format_second(ts))) == dt.datetime(2024, 1, 5, 7, 8, 9)


def test_open_interval_is_strict_and_drops_null(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 0),), (dt.datetime(2024, 1, 1, 0, 0, 0, 1),), (dt.datetime(2024, 1, 2),),
         (None,)], "t timestamp_ntz")
    got = df.where(X.open_interval("t", X.ts_literal("2024-01-01 00:00:00"), X.ts_literal("2024-01-02 00:00:00")))
    assert [r.t for r in got.collect()] == [dt.datetime(2024, 1, 1, 0, 0, 0, 1)]


def test_differs_ignores_null_changes(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b"), ("a", None), (None, None)], "x string, y string")
    got = [r.d for r in df.select(X.differs(F.col("x"), F.col("y")).alias("d")).collect()]
    assert got == [False, True, False, False, False]


@pytest.mark.parametrize("text,want", [("t", True), ("f", False), (" TRUE ", True), ("no", False), ("on", True),
                                       ("off", False), ("1", True), ("0", False), (None, None)])
def test_to_bool_accepts_database_words(spark, text, want):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(X.to_bool("s").alias("b")).first().b == want


def test_to_bool_rejects_bad_text(spark):
    df = spark.createDataFrame([("maybe",)], "s string")
    with pytest.raises(Exception, match="invalid boolean text"):
        df.select(X.to_bool("s", "iscancelable")).collect()


def test_bytes_to_mb_rounds_once_half_up(spark):
    mb = 1024 * 1024
    # 8192 bytes = 0.0078125 MB: an exact tie at the sixth digit, rounded up
    cases = {0: Decimal("0.000000"), mb: Decimal("1.000000"), 1: Decimal("0.000001"), 524: Decimal("0.000500"),
             8192: Decimal("0.007813"), 1234567890123: Decimal("1177375.688670")}
    df = spark.createDataFrame([(k,) for k in cases], "s long")
    got = {r.s: r.mb for r in df.select("s", X.bytes_to_mb("s").alias("mb")).collect()}
    assert got == cases


def test_bytes_to_mb_large_sum_exact(spark):
    s = 99_999_999 * 1024 * 1024 + 1023  # just below the decimal(14,6) limit
    df = spark.createDataFrame([(s,)], "s long")
    assert df.select(X.bytes_to_mb("s").alias("mb")).first().mb == Decimal("99999999.000976")


def test_bytes_to_mb_overflow_raises(spark):
    df = spark.createDataFrame([(100_000_000 * 1024 * 1024,)], "s long")
    with pytest.raises(Exception):
        df.select(X.bytes_to_mb("s")).collect()


def test_temp_schema_pattern_uses_wildcard_and_drops_null(spark):
    df = spark.createDataFrame([("nc_temp_1",), ("ncXtemp7",), ("nc_tempo",), ("public",), (None,), ("nc_system",)],
                               "schemaname string")
    kept = sorted(r.schemaname for r in df.where(X.not_temp_schema()).collect())
    assert kept == ["nc_system", "public"]


def test_object_label(spark):
    df = spark.createDataFrame([("relation",), ("index",), (None,)], "o string")
    assert [r.l for r in df.select(X.object_label("o").alias("l")).collect()] == ["table", "index", None]


def test_size_report_order_and_null_placement(spark):
    from sysledger.operators.sizing import table_sizes

    df = spark.createDataFrame(
        [("b", "relation", "d1", "s", "r1", "none", 10), (None, "relation", "d1", "s", "r2", "none", 5),
         ("a", "index", "d2", "s", "r3", "none", 3 * 1024 * 1024), ("a", "relation", None, "s", "r4", "none", 1),
         ("a", "relation", "d2", "s", "r5", "none", None), ("a", "relation", "d2", "s", "r6", "none", 2 * 1024 * 1024)],
        "owner_name string, object_type string, database string, schema string, relation string, "
        "compression_level string, uncompressed_size long")
    got = [(r["owner"], r["database"], r["name"], r["tbl/idx"]) for r in table_sizes(df).collect()]
    assert got == [("a", "d2", "r5", "table"), ("a", "d2", "r3", "index"), ("a", "d2", "r6", "table"),
                   ("a", None, "r4", "table"), ("b", "d1", "r1", "table"), (None, "d1", "r2", "table")]


def test_bytes_to_mb_overflow_fails_without_ansi(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        most = 10**14 * 2**20 // 10**6
        df = spark.sql(f"select cast({most - 2**20} as decimal(38,0)) as s")
        assert df.select(X.bytes_to_mb("s").alias("mb")).first().mb is not None
        with pytest.raises(Exception, match="does not fit"):
            spark.sql(f"select cast({most + 2**20} as decimal(38,0)) as s").select(X.bytes_to_mb("s")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_export_tells_null_from_empty_text(spark):
    import uuid

    from sysledger.session import checkpoint_dir
    from sysledger.sinks.export import export_text, read_export

    df = spark.createDataFrame([(1, None), (2, ""), (3, "a|b\"c"), (4, " ")], "id int, name string")
    path = f"{checkpoint_dir(spark)}/export-{uuid.uuid4().hex[:8]}"
    export_text(df, path)
    assert sorted(map(tuple, read_export(spark, path, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_files_of_mixed_versions_read_as_one_table(spark):
    import uuid

    from sysledger.schemas import SESSIONS, SESSIONS_PRE_620
    from sysledger.session import checkpoint_dir
    from sysledger.sources.catalog import read_mixed

    path = f"{checkpoint_dir(spark)}/mixed-{uuid.uuid4().hex[:8]}"
    old = spark.range(5).selectExpr("cast(id as int) as sessionid", "'old' as username", "'x' as dba_note")  # narrower, fewer, one more
    new = spark.range(5, 9).selectExpr("id as sessionid", "'new' as username", "id as parentsessionid")
    old.write.mode("append").parquet(path)
    new.write.mode("append").parquet(path)
    got = read_mixed(spark, path, SESSIONS)
    assert got.schema.fieldNames() == SESSIONS.fieldNames()
    rows = sorted((r.sessionid, r.username, r.parentsessionid, r.status) for r in got.collect())
    assert rows == [(i, "old", None, None) for i in range(5)] + [(i, "new", i, None) for i in range(5, 9)]
    old.withColumn("sessionid", old["sessionid"].cast("long")).write.mode("append").parquet(f"{path}-b")
    new.write.mode("append").parquet(f"{path}-b")
    extra = read_mixed(spark, f"{path}-b", SESSIONS_PRE_620, keep_extra=True)
    assert set(extra.columns) == {*SESSIONS_PRE_620.fieldNames(), "dba_note", "parentsessionid"}
    assert sorted((r.sessionid, r.dba_note) for r in extra.collect())[:6] == [(i, "x") for i in range(5)] + [(5, None)]
