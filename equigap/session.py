"""Session construction and the shared checkpoint folder.

On a cluster the operator names ``spark.checkpoint.dir`` (a shared,
fault-tolerant folder); we only read it.  Tests and local runs that leave it
unset get a fresh folder under /tmp.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
    # small tables in many splits, so that scans use all cores of one machine
    "spark.sql.files.maxPartitionBytes": "4m",
}


def get_session(master: str | None = None, app: str = "equigap", **conf: str) -> SparkSession:
    """Return the active session or build a local one with sane defaults."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master or os.environ.get("EQUIGAP_MASTER", "local[8]"))
    for k, v in {**_LOCAL_DEFAULTS, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and materialised intermediate tables.

    Read from ``spark.checkpoint.dir`` (or an already registered checkpoint
    folder).  Only a local master that leaves both unset (tests) gets a fresh
    folder under /tmp, removed when Python ends; on a cluster a machine-local
    folder would be another one on every executor, so an unset folder is an
    error there.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written table."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return the re-read table: later passes scan columnar files instead of
    recomputing the joins under ``df``, and a lost executor re-reads the
    files rather than the sources.  ``clear_scratch`` removes what a session
    has written, once its results are read."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all tables written under the shared folder by this session."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, ""))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
