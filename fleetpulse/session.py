"""Session construction and the shared folder for lineage cuts and scratch output."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "fleetpulse", **conf) -> SparkSession:
    """Session for tests and local runs: UTC, AQE on, no UI, no call-site capture.

    On a cluster, use the cluster's own session; the jobs set nothing
    that is only right for one machine.
    """
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Python call sites for error messages cost four py4j round trips per
        # API call while a plan is built (about 0.1 s per query here).
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    Reads `spark.checkpoint.dir` from the session. Only on a local master
    (tests) a default is set when it is unset, under the system temp
    folder; executors of a cluster would not see that folder.
    """
    base = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        import tempfile

        base = tempfile.mkdtemp(prefix="fleetpulse-ckpt-")
        spark.conf.set(CHECKPOINT_KEY, base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    sub = f"{name or 'run'}-{uuid.uuid4().hex[:12]}"
    return base.rstrip("/") + "/" + sub if "://" in base else os.path.join(base, sub)
