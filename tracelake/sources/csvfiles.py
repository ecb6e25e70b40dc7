"""CSV import with an explicit schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.operators.sinks import CSV_NULL


def unescape_csv(c: Column) -> Column:
    """Undo ``operators.sinks.escape_csv``: text between doubled backslashes is unescaped, then joined by single ones."""
    parts = F.split(c, r"\\\\")
    plain = F.transform(parts, lambda x: F.replace(F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.when(F.contains(c, F.lit("\\")), F.array_join(plain, "\\")).otherwise(c)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, *, header: bool = True, multiline: bool = False, escaped: bool = True) -> DataFrame:
    """Read CSV written by :func:`tracelake.operators.sinks.write_csv`: NULL, empty text, outer spaces and line breaks return.

    For files of other origin: ``escaped=False`` takes backslashes as they are; ``multiline`` is for quoted values that
    hold line breaks (it makes each file one split).
    """
    rows = (
        spark.read.schema(schema)
        .option("header", header)
        .option("escape", '"')
        .option("quote", '"')
        .option("nullValue", CSV_NULL)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("multiLine", multiline)
        .option("mode", "FAILFAST")
        .csv(path)
    )
    if not escaped:
        return rows
    text = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
    return rows.select(*[unescape_csv(F.col(c)).alias(c) if c in text else F.col(c) for c in rows.columns])
