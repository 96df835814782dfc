"""Session helpers for tests, the bench and local runs.

On a cluster the session comes from the platform; library code only reads
``spark.checkpoint.dir`` from it and never sets cluster settings itself.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "millstat") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # per-call Python stack capture costs several py4j round trips per function call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, sub: str | None = None) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir``; only when it is unset (a test or a
    laptop) a fresh local folder is created and registered.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="millstat-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    if sub is None:
        return base
    return base.rstrip("/") + "/" + sub


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder for one run's output."""
    import uuid

    return shared_dir(spark, f"millstat/{name}-{uuid.uuid4().hex[:12]}")


def local_fs_path(path: str) -> str:
    """Strip a file: scheme (for local test checks only)."""
    return path[len("file:"):] if path.startswith("file:") else path


os.environ.setdefault("PYSPARK_PYTHON", "python")
