"""Session settings for local runs (tests, bench).  The library itself never
creates a session; jobs on a cluster pass their own.

``CLUSTER_CONF`` lists the settings the plans are designed around at scale.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at 100 TB on a large cluster (documented in README).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # checkpointed intermediates are deleted once no plan references them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None, app: str = "auditmart") -> SparkSession:
    """A local[cpus] session with AQE, UTC and the UI off.  A checkpoint
    folder is set only when the environment does not already name one."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # catalog tables of local runs go to a scratch folder, not the cwd
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="auditmart-wh-"))
    )
    spark = builder.getOrCreate()
    sc = spark.sparkContext
    if not sc.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="auditmart-ckpt-"))
    sc.setLogLevel("ERROR")
    return spark


def apply_cluster_conf(spark: SparkSession, overrides: dict | None = None) -> dict:
    """Set the runtime SQL settings of :data:`CLUSTER_CONF` (plus
    ``overrides``) on an existing session.  Static settings (``spark.cleaner.*``
    and the like) cannot change after start-up; they are returned so the caller
    can put them into ``spark-submit --conf``."""
    conf = {**CLUSTER_CONF, **(overrides or {})}
    static = {}
    for key, value in conf.items():
        if key.startswith("spark.sql.") and key != "spark.sql.warehouse.dir":
            spark.conf.set(key, value)
        else:
            static[key] = value
    return static
