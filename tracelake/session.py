"""Session and scratch-location helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int | None = None,
    app: str = "tracelake",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for tests and the local benchmark. On a cluster use the session the platform gives you."""
    parts = shuffle_partitions or (os.cpu_count() if cpus == "*" else int(cpus))
    builder = SparkSession.builder
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    Reads ``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) from the session. When neither is set, a
    single-machine session (``local[...]``) gets a folder of its own; any other master raises, because executors
    would write to their own disks.
    """
    root = None
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tracelake-chk-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique location below the checkpoint root (never reused, never cleared)."""
    return f"{checkpoint_root(spark)}/tracelake/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the checkpoint root and read it back: the input of several passes is computed once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does ``path`` exist (any Hadoop-compatible file system)? Falls back to a read attempt without the JVM view."""
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))
    except Exception:
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except Exception:
            return False
