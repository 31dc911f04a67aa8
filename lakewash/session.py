"""Session helpers: a local builder for tests and benches, the scratch area for
round trips, and the time-zone pin the cleaners rely on.

No module in the package builds a session at import time; jobs take the
session they are given.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app_name: str = "lakewash") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off, UTC.

    On a cluster, build the session with the cluster's own settings and pass
    it in; nothing here is needed there except :func:`pin_utc`.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.driver.memory", os.environ.get("LAKEWASH_DRIVER_MEMORY", "8g"))
        # a fresh warehouse for catalog tables written by tests and benches
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-warehouse-", dir="/tmp"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Cleaned timestamps are instants read and written in UTC.

    Target tables hold ``TIMESTAMP`` without a zone, so the wall clock that
    reaches them must not depend on the machine the job happens to run on.
    """
    if spark.conf.get("spark.sql.session.timeZone", None) != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session without one gets its own
    folder (tests); on a cluster a missing setting is an error, because a
    machine-local folder would not be visible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a folder every "
                "executor can reach before running jobs that stage data")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/lakewash/{label}-{uuid.uuid4().hex}"
