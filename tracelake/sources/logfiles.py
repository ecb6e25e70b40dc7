"""Trace files as a splittable line source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracelake.functions.text import lossy_utf8, strict_utf8

ENCODING_POLICIES = ("strict", "lossy", "none")


def read_log_files(
    spark: SparkSession, paths: str | Sequence[str], lineage: bool = True, encoding: str = "strict"
) -> DataFrame:
    """One row per line (column ``value``) of text files, directories or globs.

    Lines end at ``\\n`` only (a lone ``\\r`` stays inside the line); one trailing ``\\r`` is removed, so ``\\r\\n``
    files read like ``\\n`` files. A missing path raises Spark's ``PATH_NOT_FOUND`` unchanged. With ``lineage``
    the file path and the start of the split are kept (``file_path``, ``file_block_start``) for per-file grouping.

    ``encoding``: ``strict`` fails the job on a line that is not valid UTF-8 (the error names the file), ``lossy``
    replaces invalid sequences with U+FFFD, ``none`` passes the bytes through unchecked.
    """
    if encoding not in ENCODING_POLICIES:
        raise ValueError(f"encoding must be one of {ENCODING_POLICIES}")
    if isinstance(paths, str):
        paths = [paths]
    raw = spark.read.option("lineSep", "\n").text(list(paths))
    text = F.col("value")
    if encoding == "strict":
        error = F.raise_error(F.concat(F.lit("invalid UTF-8 in "), F.col("_metadata.file_path")))
        text = F.when(strict_utf8(text), text).otherwise(error.cast("string"))
    elif encoding == "lossy":
        text = lossy_utf8(text)
    value = F.when(text.endswith("\r"), text.substr(F.lit(1), F.char_length(text) - 1)).otherwise(text).alias("value")
    if not lineage:
        return raw.select(value)
    return raw.select(
        value,
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
    )


def utf8_rejects(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines that are not valid UTF-8 (read with ``encoding="none"``; the strict policy fails on these)."""
    return lines.where(~strict_utf8(line_col))
