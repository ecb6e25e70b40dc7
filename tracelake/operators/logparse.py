"""Trace lines -> typed log rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.functions.logline import event_time, is_trace_line, trace_parts, trace_rows


def parse_log_lines(lines: DataFrame, line_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Keep the lines that match the trace pattern and split them into ``timestamp, level, component, message``.

    Non-matching lines produce no row (see :func:`log_rejects` to count or keep them). ``keep`` carries extra
    input columns (e.g. ``file_path``) through. Plan: scan -> Project -> Generate(inline), all in one
    whole-stage-codegen span, no shuffle; the regex runs once per line.
    """
    keep = list(keep)
    staged = lines.select(*keep, F.col(line_col).alias("_line"), trace_parts(line_col).alias("_parts"))
    return staged.select(*keep, F.inline(trace_rows("_line", "_parts")))


def log_rejects(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines the trace pattern does not accept (stack-trace continuations, blank or NULL lines, other formats)."""
    return lines.where(~F.coalesce(is_trace_line(line_col), F.lit(False)))


def with_event_time(rows: DataFrame, col: str = "timestamp", out: str = "event_time") -> DataFrame:
    """Add a nullable ``timestamp_ntz`` parsed from the verbatim timestamp text."""
    return rows.withColumn(out, event_time(col))
