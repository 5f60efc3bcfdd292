"""Table sizing report: uncompressed size per relation in MB."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import bytes_to_mb, object_label

# Display names of the report columns (fixed values).
SIZE_REPORT_COLUMNS = ["owner", "tbl/idx", "database", "schema", "name", "cmp lvl", "MB Uncompressed"]


def table_sizes(relation_stats: DataFrame, ordered: bool = True) -> DataFrame:
    """Sum of uncompressed bytes per (owner, type, database, schema,
    relation, compression level), as decimal(14,6) MB.

    The sum is partial-aggregated before the shuffle on the six keys, so
    a relation holding a large share of the rows costs one row per input
    partition in the exchange. Ordered as owner, database, size desc with
    the source database's null placement (nulls last ascending, first
    descending)."""
    grouped = (
        relation_stats
        .groupBy(
            F.col("owner_name").alias("owner"),
            object_label("object_type").alias("tbl/idx"),
            F.col("database"),
            F.col("schema"),
            F.col("relation").alias("name"),
            F.col("compression_level").alias("cmp lvl"),
        )
        .agg(F.sum("uncompressed_size").alias("_bytes"))
        .select(*SIZE_REPORT_COLUMNS[:-1], bytes_to_mb("_bytes").alias("MB Uncompressed"))
    )
    if not ordered:
        return grouped
    return grouped.orderBy(
        F.col("owner").asc_nulls_last(),
        F.col("database").asc_nulls_last(),
        F.col("MB Uncompressed").desc_nulls_first(),
    )
