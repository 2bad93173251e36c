"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the jobs count on.  The last one lets adaptive execution split a hot join key even when a
# later aggregation could have reused the join's partitioning.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share; a local folder is made only for a local master without one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix="chartmill-")


def run_dir(spark: SparkSession, label: str, root: str | None = None) -> str:
    """A new folder below `root` or else the session's shared scratch folder, never used twice."""
    return f"{(root or scratch_root(spark)).rstrip('/')}/chartmill/{label}-{uuid.uuid4().hex}"
