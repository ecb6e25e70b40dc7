"""Trace-line pattern and the expressions that split a line into a log row.

Java regex semantics are aligned with the expected line semantics by two inline flags:
``d`` (UNIX_LINES: only ``\\n`` ends a line, so ``.`` and ``$`` accept ``\\r``, U+0085, U+2028 inside a message)
and ``U`` (UNICODE_CHARACTER_CLASS: ``\\s``, ``\\S`` and ``\\d`` are Unicode classes).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# The trace-line pattern (bracket prefix, timestamp, one-letter level, component,
# source file with line, colon, message). Groups: 1 timestamp, 2 level, 3 component, 4 message.
TRACE_PATTERN = (
    r"^\[[^\]]*\]\{[^}]*\}\[[^\]]*\]\s+"
    r"(\d{4}-\d{2}-\d{2}\s+\d{2}:\d{2}:\d{2}\.\d+)\s+"
    r"([a-zA-Z])\s+"
    r"(\S+)\s+"
    r"\S+\([^)]*\)\s*:\s*"
    r"(.*)$"
)
JAVA_FLAGS = "(?dU)"
FULL_PATTERN = JAVA_FLAGS + TRACE_PATTERN

# Separator of the one-pass form. A line that already contains it takes the four-extract path.
_SEP = "\u0001"
_REPLACEMENT = _SEP.join(["$1", "$2", "$3", "$4"])


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trace_parts(line: Column | str = "value") -> Column:
    """One regex pass: a matching line becomes its four groups joined by U+0001, then ``split`` cuts them apart.

    A non-matching line comes back from ``regexp_replace`` unchanged and so splits into fewer than four parts
    (unless it already holds U+0001 - :func:`trace_rows` sends those lines down the four-extract path).
    """
    return F.split(F.regexp_replace(_as_col(line), FULL_PATTERN, _REPLACEMENT), _SEP, 4)


def trace_rows(line: Column | str = "value", parts: Column | str = "_parts") -> Column:
    """``array<struct<timestamp, level, component, message>>``: one element for a trace line, none otherwise.

    ``parts`` must be :func:`trace_parts` of the same line, materialised as a column of a child projection so the
    regex runs once per line. Lines that contain U+0001 use ``rlike`` + four ``regexp_extract`` calls instead.
    An array (not a filter) lets the caller ``inline`` it: a filter on the result would be pushed below the
    projection and evaluate the regex a second time.
    """
    line, parts = _as_col(line), _as_col(parts)
    one_pass = F.when(
        F.size(parts) == 4,
        F.array(
            F.struct(
                parts.getItem(0).alias("timestamp"),
                parts.getItem(1).alias("level"),
                parts.getItem(2).alias("component"),
                parts.getItem(3).alias("message"),
            )
        ),
    )
    four_pass = F.when(
        line.rlike(FULL_PATTERN),
        F.array(
            F.struct(
                F.regexp_extract(line, FULL_PATTERN, 1).alias("timestamp"),
                F.regexp_extract(line, FULL_PATTERN, 2).alias("level"),
                F.regexp_extract(line, FULL_PATTERN, 3).alias("component"),
                F.regexp_extract(line, FULL_PATTERN, 4).alias("message"),
            )
        ),
    )
    none = F.array().cast("array<struct<timestamp:string,level:string,component:string,message:string>>")
    return F.coalesce(F.when(F.instr(line, _SEP) == 0, one_pass).otherwise(four_pass), none)


def is_trace_line(line: Column | str = "value") -> Column:
    """Boolean: the line matches the trace pattern."""
    return _as_col(line).rlike(FULL_PATTERN)


@functools.lru_cache(maxsize=1)
def _unicode_digits() -> tuple[str, str]:
    """Every Unicode decimal digit (category Nd) and its ASCII value, built from the Unicode database (once)."""
    import sys
    import unicodedata

    src, dst = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        ch = chr(cp)
        if unicodedata.category(ch) == "Nd":
            src.append(ch)
            dst.append(str(unicodedata.decimal(ch)))
    return "".join(src), "".join(dst)


def event_time(timestamp: Column | str = "timestamp") -> Column:
    """Nullable ``timestamp_ntz`` from the verbatim timestamp text.

    Inner whitespace runs are collapsed to one space and non-ASCII decimal digits (which the pattern accepts)
    are mapped to ASCII first; impossible dates (``9999-99-99``) give NULL; more than six fractional digits are
    cut to microseconds by the cast.
    """
    digits_from, digits_to = _unicode_digits()
    text = F.translate(F.regexp_replace(_as_col(timestamp), r"(?U)\s+", " "), digits_from, digits_to)
    return text.try_cast("timestamp_ntz")


def first_char(c: Column | str, default: str = "?") -> Column:
    """First character of a string (Unicode code point), ``default`` when empty or NULL."""
    c = _as_col(c)
    return F.when(F.char_length(c) >= 1, F.substring(c, 1, 1)).otherwise(F.lit(default))
