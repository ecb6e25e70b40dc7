"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from tracelake.functions.logline import TRACE_PATTERN, event_time, trace_parts, trace_rows
from tracelake.functions.text import parse_unsigned, strict_utf8, lossy_utf8, unicode_trim

__all__ = [
    "TRACE_PATTERN",
    "event_time",
    "trace_parts",
    "trace_rows",
    "parse_unsigned",
    "strict_utf8",
    "lossy_utf8",
    "unicode_trim",
]
