"""Session and shared-folder helpers.

Jobs that must cut lineage or hand data to a streaming query write to the
shared folder named by ``spark.checkpoint.dir``.  On a cluster that setting is
provided by the deployment; only a local session (tests, benches) gets a
private folder created here when the setting is missing.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(master: str = "local[8]", app: str = "tidemark",
              shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """A session configured the way the library expects (AQE on, UI off)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session; set a private folder only for local sessions where
    nothing is configured.  A cluster session without the setting is an error:
    a machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                f"{_CHECKPOINT_KEY} is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-", dir="/tmp")
        spark.conf.set(_CHECKPOINT_KEY, root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: a cluster's
    workers do not see the driver's folders."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(here)
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-zip-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, top))
    sc.addPyFile(path)
    sc._tidemark_shipped = True
