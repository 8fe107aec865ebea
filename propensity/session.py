"""Session helpers: a tuned local session for tests/bench, and the shared
scratch/checkpoint folder every job that cuts lineage or round-trips files
must use.

On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared,
fault-tolerant filesystem).  Only a local-mode session with no such
setting (tests, the bench, the smoke check) gets a fresh temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins/partition counts at run
# time, skew-join splitting handles hot keys, UTC makes timestamps stable.
CLUSTER_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files are removed once their DataFrame is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "propensity") -> SparkSession:
    """Session for tests and the bench (local mode, UI off)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024)))
    for k, v in CLUSTER_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, wiring it into the SparkContext.

    Reads ``spark.checkpoint.dir`` from the session.  Falls back to a fresh
    local temp folder only when running in local mode with nothing set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="propensity-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
