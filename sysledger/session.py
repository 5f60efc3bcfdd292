"""Session helpers.

Operators never read configuration to decide what they compute; these
helpers only build a session for tests/bench and find the shared folder
for checkpoints and snapshots.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults for a session we create ourselves (tests, bench). On a cluster
# the deployment's own settings win: builder.config only fills the gaps
# of a fresh session.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, app: str = "sysledger", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found
    try:  # a classic session may have had it set through the context
        return spark.sparkContext.getCheckpointDir() or None
    except Exception:  # Spark Connect: no context on the client
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's spark.checkpoint.dir; only when it is unset and the
    master is local (tests) make a fresh scratch folder for this process. On a
    cluster every executor would write to a disk of its own."""
    found = checkpoint_dir(spark)
    if found:
        return found
    master = spark.conf.get("spark.master", "") or ""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    found = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    try:
        spark.sparkContext.setCheckpointDir(found)
    except Exception:
        spark.conf.set("spark.checkpoint.dir", found)
    return found
