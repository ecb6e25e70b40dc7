"""Catalog lookups: table existence, current schema, column metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

COLUMNS = T.StructType(
    [
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type_name", T.StringType(), False),
        T.StructField("length", T.IntegerType(), True),
        T.StructField("scale", T.IntegerType(), True),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("is_nullable", T.BooleanType(), False),
    ]
)


def table_exists(spark: SparkSession, name: str) -> bool:
    """Catalog lookup (no row count): does the table or view exist in the current or given namespace?"""
    return spark.catalog.tableExists(name)


def current_schema(spark: SparkSession) -> str:
    return spark.catalog.currentDatabase()


#: Where Spark keeps the declared type of a CHAR or VARCHAR column, whose values it handles as STRING.
_DECLARED = "__CHAR_VARCHAR_TYPE_STRING"


def _type(f: T.StructField) -> tuple[str, int | None, int | None]:
    """Declared type name, length (or precision) and scale of a column."""
    declared = f.metadata.get(_DECLARED)
    if declared:
        return declared.upper(), int(declared.rstrip(")").rsplit("(", 1)[1]), None
    dt = f.dataType
    if isinstance(dt, T.DecimalType):
        return dt.simpleString().upper(), dt.precision, dt.scale
    if isinstance(dt, (T.VarcharType, T.CharType)):
        return dt.simpleString().upper(), dt.length, None
    return dt.simpleString().upper(), None, None


def columns_of(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """Column metadata ``(column_name, data_type_name, length, scale, position, is_nullable)`` ordered by position.

    ``source`` is a table name or a DataFrame; only the schema is read (no data). Of a table the declared types count
    (VARCHAR(n), CHAR(n)), and columns that writes to it require (``sinks.required_columns``) are not nullable.
    """
    from tracelake.operators.sinks import required_columns

    schema, required = source, ()
    if isinstance(source, str):
        schema, required = spark.table(source), set(required_columns(spark, source))
    rows = []
    for i, f in enumerate(schema.schema.fields, start=1):
        name, length, scale = _type(f)
        rows.append((f.name, name, length, scale, i, f.nullable and f.name not in required))
    return spark.createDataFrame(rows, COLUMNS)
