"""Session settings and the shared working folder.

Library code never creates a session; callers own it. ``local_session`` is the
one used by tests and the bench. ``shared_dir`` is where jobs put anything
that must outlive a task: it is the cluster's ``spark.checkpoint.dir``; only
when that is unset (local runs, tests) is a private folder created.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings the engine relies on; all can be changed at runtime.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Overwrites replace only the partitions written. Inserts that name a
    # literal partition value (stage / reject / ODS by date) still clear that
    # partition even when no row is written; a full overwrite of an
    # unpartitioned table is unaffected.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Writes to a few partitions (the layers of a staged write) keep a file of
    # each open instead of sorting all rows by partition first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "landfall",
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", driver_memory)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.session.timeZone", "UTC"))
    for k, v in {**RUNTIME_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def runtime_conf(spark: SparkSession) -> dict:
    """The session's present values of the engine's settings, for ``restore_conf``."""
    return {k: spark.conf.get(k, None) for k in RUNTIME_CONF}


def restore_conf(spark: SparkSession, values: dict) -> None:
    for k, v in values.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the engine's runtime SQL settings on a session the caller created."""
    for k, v in RUNTIME_CONF.items():
        spark.conf.set(k, v)


def _context(spark: SparkSession):
    """The SparkContext of a classic session, None on Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the platform and read as is. When it is unset
    (local tests), a private folder is created and registered as the session's
    checkpoint directory so ``checkpoint()`` and written work tables agree.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d and sc is not None and not (sc.master.startswith("local") and not sc.master.startswith("local-cluster")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="landfall-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def set_scheduler_pool(spark: SparkSession, pool: "str | None") -> None:
    """Run this thread's jobs in ``pool`` (effective under FAIR scheduling; no-op on Connect)."""
    sc = _context(spark)
    if sc is not None:
        sc.setLocalProperty("spark.scheduler.pool", pool)


def hadoop_path(spark: SparkSession, folder: str):
    """The file system of a folder and its path, as Hadoop objects: any store that Spark reaches."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Have a written working folder removed when the driver ends (a folder that is gone by then is passed over)."""
    fs, path = hadoop_path(spark, folder)
    fs.deleteOnExit(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused, never a local temp dir on a cluster)."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
