"""Session construction and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "curate", driver_memory: str = "8g",
                extra: dict[str, str] | None = None) -> SparkSession:
    """A session with AQE (coalescing, skew joins) on, UI off and UTC time."""
    cpus = os.environ.get("BENCH_CPUS") or "8"
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local-mode session without one (tests) gets a private folder; on a
    cluster a missing setting is an error rather than a machine-local folder.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        # A machine-local folder is invisible to executors on other hosts.
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) "
                           "before running file-writing flows on a cluster")
    local = tempfile.mkdtemp(prefix="curate-ckpt-")
    sc.setCheckpointDir(local)
    return local


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint folder (not created)."""
    return f"{checkpoint_dir(spark)}/curate-{name}-{uuid.uuid4().hex[:12]}"
