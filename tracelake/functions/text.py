"""Text helpers: Unicode trim, unsigned parse, UTF-8 policies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_trim(c: Column | str) -> Column:
    """Trim Unicode whitespace on both ends (SQL ``TRIM`` only removes spaces)."""
    return F.regexp_replace(_as_col(c), r"(?U)^\s+|\s+$", "")


def parse_unsigned(c: Column | str) -> Column:
    """Text -> non-negative bigint (outer Unicode white space aside), NULL when it does not parse or has a minus sign."""
    text = unicode_trim(c)
    n = text.try_cast("bigint")
    return F.when((n >= 0) & ~F.startswith(text, F.lit("-")), n)


def strict_utf8(c: Column | str) -> Column:
    """Boolean: binary/string is valid UTF-8."""
    return F.is_valid_utf8(_as_col(c).cast("string"))


def lossy_utf8(c: Column | str) -> Column:
    """Replace invalid UTF-8 sequences with U+FFFD."""
    return F.make_valid_utf8(_as_col(c).cast("string"))
