"""Session helpers: a local session for tests/bench and the checkpoint folder rule."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings a settlement job relies on at any scale: AQE re-plans joins from
# measured shuffle sizes (runtime broadcast, partition coalescing, skew-join
# splitting), ANSI keeps arithmetic errors loud, timestamps are pinned to UTC.
# Broadcast joins follow Spark's own byte thresholds; explicit hints are used
# only for data of a proven bound.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "apportion") -> SparkSession:
    """A local-mode session for tests and the bench (UI off, no server)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers.

    Arrow passes (``mapInArrow``/``mapInPandas``) run library functions on the
    executors, so the package is zipped once per driver process and added
    with ``addPyFile`` (Spark ships it to every executor); with Spark Connect
    it is added as a Python artifact.
    """
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:
        sc, key = None, "connect"
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="apportion-pkg-"), "apportion.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    zf.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The folder comes from the session (a file system that all executors
    share). Only a local master, where driver and executors are one process,
    gets a temporary folder when the setting is unset; it is removed at exit.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session: the server owns the setting
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on this Spark Connect session")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="apportion-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
