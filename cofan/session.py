"""Session helpers.

Library functions never create or stop a session: they take the caller's.
``local_session`` is for tests, the bench and command-line runs on one host.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cofan") -> SparkSession:
    """A single-host session with AQE on, UI off and a UTC clock."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Remove reliable checkpoint files once their DataFrames are gone.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("COFAN_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a folder every executor can
    reach); a local session without it uses a folder of its warehouse.
    The folder is also registered with the SparkContext so that ``checkpoint()``
    and iterative ML algorithms use it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        # A folder the caller already registered with the SparkContext wins.
        registered = spark.sparkContext.getCheckpointDir()
        if registered:
            return registered
    if not path:
        if not is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a shared folder is required on a cluster"
            )
        path = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        try:
            spark.conf.set("spark.checkpoint.dir", path)
        except Exception:  # some deployments freeze core settings at runtime
            pass
    spark.sparkContext.setCheckpointDir(path)
    return path
