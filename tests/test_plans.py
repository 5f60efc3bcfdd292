"""Physical-plan properties: broadcast listings, anti-join merges, pruned
scans, partial aggregation, and no Python in any registered query."""

from __future__ import annotations

import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from sysledger.plans.scenarios import QUERIES


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))  # the corpus operators have plan tests of their own
def test_no_python_in_plan(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert marker not in p, f"{name} runs Python: {marker}"


@pytest.mark.parametrize("name", ["list_tables", "list_views", "list_functions"])
def test_listings_broadcast_schemas(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


@pytest.mark.parametrize("name", ["merge_statements", "merge_sessions"])
def test_merge_is_broadcast_anti_join(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    assert "LeftAnti" in p and "BroadcastHashJoin" in p


def test_listing_scan_reads_only_needed_columns(spark):
    df = E.queries()["list_tables"](spark, SF_SMALL)
    p = plan(df)
    assert "p_retailprice" not in p  # part has it; the listing never needs it


def test_size_report_aggregates_before_shuffle(spark):
    p = plan(E.queries()["table_sizes"](spark, SF_SMALL))
    assert "partial_sum" in p


def test_sync_users_pre_aggregates_sessions(spark):
    p = plan(E.queries()["sync_users"](spark, SF_SMALL))
    assert "partial_max" in p


def test_few_rows_with_long_strings_are_not_broadcast(spark):
    from sysledger.plans.hints import fits_broadcast, fits_broadcast_all

    df = spark.range(20).selectExpr("id", "repeat('x', 100000) as path")
    assert fits_broadcast(df, max_bytes=4_000_000)
    assert not fits_broadcast(df, max_bytes=1_000_000)
    assert fits_broadcast_all(df, spark.range(20).toDF("id"), max_bytes=1_000_000) == [False, True]


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    from sysledger import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
