"""Session helpers: a local session for tests and benches, and the
shared scratch folder (taken from ``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "rankforge") -> SparkSession:
    """Local session with AQE on and the UI off (tests and benches only)."""
    parts = shuffle_partitions or (8 if cores == "*" else max(2, int(cores)))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RANKFORGE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local session (one machine, as in tests) may
    leave both unset: it gets a temporary folder, removed at exit. On a
    cluster an unset folder is an error, since its machines share no disk."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="rankforge-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/rankforge-scratch/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str = "table"):
    """Write ``df`` as a parquet table under the shared checkpoint folder
    and read it back: cuts the lineage (a rerun after an executor loss
    starts from the table) and lets several jobs share one computation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def file_system(spark: SparkSession, path: str):
    """(file system, path object) of the Hadoop path ``path``: works for any store that Spark reaches."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch tables under the shared checkpoint folder.

    For the end of a job: frames that still read such tables can't be used afterwards."""
    files, path = file_system(spark, f"{checkpoint_root(spark)}/rankforge-scratch")
    files.delete(path, True)
