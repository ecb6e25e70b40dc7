"""Helpers shared by the operators of this package."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handled at a time inside a task; one longer text makes a slice of its own.
SLICE_BYTES = 4 << 20
_SHIPPED = "tracelake.llm.shipped"


def ship(spark: SparkSession) -> None:
    """Give executors this package (as ``--py-files`` would), once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_tracelake_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tracelake-py-"), "tracelake_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("tracelake", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._tracelake_shipped = True


def ship_file(spark: SparkSession, path: str) -> str:
    """Send a file of the driver to the executors; returns its name there, made from its content.

    Two files of one base name stay apart, and the same content is sent once per application.
    """
    with open(path, "rb") as f:
        data = f.read()
    name = f"{hashlib.sha256(data).hexdigest()[:24]}-{os.path.basename(path)}"
    sc = spark.sparkContext
    if not any(f.endswith("/" + name) for f in sc.listFiles):
        copy = os.path.join(tempfile.mkdtemp(prefix="tracelake-file-"), name)
        with open(copy, "wb") as f:
            f.write(data)
        sc.addFile(copy)
    return name


def shipped_file(name: str) -> str:
    """Inside a task: where the file sent under ``name`` is."""
    from pyspark import SparkFiles

    return SparkFiles.get(name)


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset (tests), a new one is set for this session.

    Only a single-machine master may get a folder of its own: elsewhere executors would not see it, so it raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="tracelake-shared-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_root(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def as_bytes(col: str | Column) -> Column:
    """UTF-8 bytes of a text column; null counts as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("binary"), F.lit(b""))


def byte_slices(arr: pa.Array, limit: int = SLICE_BYTES):
    """Cut a binary array into slices of about ``limit`` bytes (at least one value each)."""
    n = len(arr)
    if not n:
        return
    total = np.cumsum(pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    i, done = 0, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield arr.slice(i, j - i)
        done, i = int(total[j - 1]), j


def batch_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Like ``byte_slices`` for a whole batch, by the bytes of one column."""
    at = 0
    for part in byte_slices(batch.column(batch.schema.get_field_index(column)), limit):
        yield batch.slice(at, len(part))
        at += len(part)
