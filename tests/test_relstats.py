"""Size estimate of a relation from its rows (S5)."""

from __future__ import annotations

from decimal import Decimal

import pytest

from sysledger.sources.relstats import relation_stats


def test_size_rule_counts_bytes_widths_and_arrays(spark):
    df = spark.createDataFrame(
        [(1, "héllo", [1.0, 2.0], Decimal("1.50"), True), (None, None, None, None, None), (3, "", [], Decimal("2.00"), False)],
        "id long, txt string, vec array<float>, amount decimal(10,2), flag boolean")
    r = relation_stats(df, owner="o", database="d", schema="s", relation="r").first()
    # ids 2x8, text 6+0 bytes (UTF-8), vectors (2+0)x4, decimals 2x8, flags 2x1; nulls count 0
    assert r.uncompressed_size == 16 + 6 + 8 + 16 + 2
    assert (r.owner_name, r.object_type, r.database, r.schema, r.relation, r.compression_level) == \
        ("o", "relation", "d", "s", "r", "none")


def test_empty_relation_has_size_zero(spark):
    df = spark.createDataFrame([], "id long, txt string")
    assert relation_stats(df, owner="o", database="d", schema="s", relation="r").first().uncompressed_size == 0


@pytest.mark.parametrize("name", ["documents", "pages", "conversations", "orders", "part", "customer"])
def test_each_given_table_is_exact(spark, name):
    """One-file relations: every value of every row counts."""
    from conftest import SF_SMALL

    from sysledger import fixtures as fx

    df = fx.table(spark, SF_SMALL, name)
    widths = {"bigint": 8, "int": 4, "double": 8, "timestamp_ntz": 8, "timestamp": 8, "date": 4, "boolean": 1, "float": 4}
    want = 0
    for row in df.collect():
        for value, (_, kind) in zip(row, df.dtypes, strict=True):
            if value is not None:
                want += len(value.encode()) if kind == "string" else widths[kind]
    assert relation_stats(df, owner="o", database="d", schema="s", relation=name).first().uncompressed_size == want
