"""Session helpers for tests, the bench and command-line use.

Library operators never build or reconfigure a session; the caller owns it. The helpers here
only (a) build a local session for tests/bench and (b) find the shared folder that a cluster
names in ``spark.checkpoint.dir`` for intermediate tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """A local-mode session with the settings our tests and bench rely on."""
    parts = shuffle_partitions if shuffle_partitions is not None else 8
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no per-call Python call-site capture (several driver round trips per function call)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and tasks run in one process (so that they share every local folder)."""
    return spark.sparkContext.master.split("[")[0] == "local"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session, or the
    checkpoint folder its context was given.

    Where neither is set, a local session (tests, the local bench) gets a scratch folder of its
    own, registered as its checkpoint folder; on a cluster that is an error, because executors
    would each write to their own disk."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               "executors share; intermediate tables are written there")
        d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never cleared in place)."""
    return f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable by the session's Python workers, as ``--py-files`` would.

    Functions that run in Python workers refer to package functions, so a worker must be able to
    import ``tessera`` even when the driver was started from another directory. Done once per
    application: a zip in a driver-side temporary folder, which ``addPyFile`` sends to every
    executor (Spark's own file transfer; no shared folder is involved)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"tessera-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w") as zf:
        for root, _, files in os.walk(package):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(root, name)
                    zf.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)
