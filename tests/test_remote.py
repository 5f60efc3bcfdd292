"""Remote extract over JDBC (S2) against an in-process Derby database
(embedded, in memory: no server, no port)."""

from __future__ import annotations

import uuid

from conftest import SF_SMALL
from pyspark.sql import functions as F

from sysledger import fixtures as fx
from sysledger.operators import capture
from sysledger.sources.remote import read_remote, window_query

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_windowed_parallel_extract_equals_local_filter(spark):
    url = f"jdbc:derby:memory:sl{uuid.uuid4().hex[:8]};create=true"
    src = fx.statements_src(spark, SF_SMALL)
    src.write.format("jdbc").option("url", url).option("dbtable", "NC_ALL_STATEMENTS").options(**DRIVER).save()
    low, high = "2024-01-14 22:58:18", "2024-01-25 00:00:00"  # sf0.001 watermark
    query = window_query("NC_ALL_STATEMENTS", "*", "\"endtime\"", low, high)
    remote = read_remote(spark, url, query, properties=DRIVER, partition_column="statementid",
                         lower_bound=0, upper_bound=1000, num_partitions=4)
    assert remote.rdd.getNumPartitions() == 4
    remote = remote.toDF(*[c.lower() for c in remote.columns])
    staged = capture.extract_statements(remote, low, high)
    local = capture.extract_statements(src, low, high)
    assert staged.exceptAll(local).count() == 0 and local.exceptAll(staged).count() == 0
    assert staged.count() == 299
    assert staged.where(F.col("iscancelable").isNull()).count() == 0


def test_windowed_source_splits_only_the_window(spark):
    from sysledger.sources.remote import windowed_source

    url = f"jdbc:derby:memory:sl{uuid.uuid4().hex[:8]};create=true"
    src = fx.statements_src(spark, SF_SMALL)
    src.toDF(*[c.upper() for c in src.columns]).write.format("jdbc").option("url", url) \
        .option("dbtable", "NC_ALL_STATEMENTS").options(**DRIVER).save()
    make = windowed_source(spark, url, "NC_ALL_STATEMENTS", "ENDTIME", properties=DRIVER,
                           partition_column="STATEMENTID", num_partitions=4)
    low, high = "2024-01-14 22:58:18", "2024-01-25 00:00:00"
    rows = make(low, high)
    assert 2 < rows.rdd.getNumPartitions() <= 4
    assert capture.extract_statements(rows, low, high).count() == 299
    assert rows.count() == 299  # the database sent only the window


def even(df, n):
    """Rows by partition, none far from its share."""
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert len(counts) > 2 and max(counts) <= 1.6 * sum(counts) / n, counts
    return sum(counts)


def test_skewed_columns_are_split_evenly_without_a_flag(spark):
    """Nine tenths of the rows in a thousandth of the key range and in one hour
    of the window."""
    from sysledger.sources.remote import read_split, split_predicates, windowed_source

    url = f"jdbc:derby:memory:sl{uuid.uuid4().hex[:8]};create=true"
    rows = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, F.col("id") * 1_000_000).otherwise(F.col("id")).alias("K"),
        F.expr("timestamp_ntz'2024-01-05 00:00:00' + make_dt_interval(0, if(id % 10 = 0, id % 480, 7), 0, if(id % 10 = 0, 0, id % 3600))").alias("T"),
        F.when(F.col("id") % 100 == 0, F.lit(None).cast("long")).otherwise(F.col("id")).alias("N"))
    rows.write.format("jdbc").option("url", url).option("dbtable", "LOGGED").options(**DRIVER).save()
    want = sorted(map(tuple, rows.collect()), key=repr)
    for column in ("K", "T", "N"):
        got = read_split(spark, url, "SELECT * FROM LOGGED", column, 8, properties=DRIVER)
        assert even(got, 8) == 4000
        assert sorted(map(tuple, got.collect()), key=repr) == want  # every row once, nulls too
    window = windowed_source(spark, url, "LOGGED", "T", properties=DRIVER)("2024-01-05 00:00:00", "2024-01-20 00:00:00")
    assert even(window, 8) == rows.where("T > timestamp_ntz'2024-01-05 00:00:00' and T < timestamp_ntz'2024-01-20 00:00:00'").count()
    assert split_predicates(spark, url, "SELECT * FROM LOGGED WHERE K < 0", "K", 8, properties=DRIVER) == []
    assert read_split(spark, url, "SELECT * FROM LOGGED WHERE K < 0", "K", 8, properties=DRIVER).count() == 0
    assert read_split(spark, url, "SELECT * FROM LOGGED WHERE K = 1", "K", 8, properties=DRIVER).count() == 1
