"""Fixed row schemas. Nothing in tracelake infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# One parsed trace line. All four fields are required strings; ``level`` holds one character.
LOG_ENTRY = T.StructType(
    [
        T.StructField("timestamp", T.StringType(), False),
        T.StructField("level", T.StringType(), False),
        T.StructField("component", T.StringType(), False),
        T.StructField("message", T.StringType(), False),
    ]
)
LOG_FIELDS = tuple(LOG_ENTRY.fieldNames())

# One row of the users table: id >= 0 and unique, name not null and at most 255 characters.
USER_ROW = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("name", T.StringType(), False),
    ]
)

OP_LOG = T.StructType(
    [
        T.StructField("op", T.StringType(), True),
        T.StructField("happened_at", T.TimestampNTZType(), True),
        T.StructField("n_rows", T.LongType(), True),
    ]
)

# Column set of Spark's Kafka source; a "topic table" (Parquet directory) uses the same columns.
TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType(), True),
        T.StructField("value", T.BinaryType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampType(), True),
        T.StructField("timestampType", T.IntegerType(), True),
    ]
)

# Landing table: the four log columns, where each row came from, then the replay-safe partition columns.
LOG_TABLE = T.StructType(
    list(LOG_ENTRY.fields)
    + [
        T.StructField("src_topic", T.StringType()),
        T.StructField("src_partition", T.IntegerType()),
        T.StructField("src_offset", T.LongType()),
        T.StructField("src_pos", T.IntegerType()),
        T.StructField("ingest", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
LOG_TABLE_PARTITIONS = ("ingest", "batch_id")

# Messages the strict decoder rejected (quarantine mode).
QUARANTINE_TABLE = T.StructType(
    [
        T.StructField("src_topic", T.StringType()),
        T.StructField("src_partition", T.IntegerType()),
        T.StructField("src_offset", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("ingest", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# SQL type names of the handbook mapped to Spark types (TIME needs spark.sql.timeType.enabled).
SQL_TYPE_MAP = {
    "TINYINT": T.ShortType(),
    "SMALLINT": T.ShortType(),
    "INTEGER": T.IntegerType(),
    "BIGINT": T.LongType(),
    "REAL": T.FloatType(),
    "DOUBLE": T.DoubleType(),
    "NVARCHAR": T.StringType(),
    "VARCHAR": T.StringType(),
    "NCLOB": T.StringType(),
    "DATE": T.DateType(),
    "SECONDDATE": T.TimestampNTZType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "VARBINARY": T.BinaryType(),
    "BLOB": T.BinaryType(),
}


def spark_type(sql_type: str) -> T.DataType:
    """Map a handbook SQL type (``DECIMAL(p,s)``, ``NVARCHAR(255)``, ``BIGINT`` ...) to a Spark type."""
    name = sql_type.strip().upper()
    base, _, args = name.partition("(")
    base = base.strip()
    if base == "DECIMAL":
        p, _, s = args.rstrip(")").partition(",")
        return T.DecimalType(int(p or 38), int(s or 0))
    if base not in SQL_TYPE_MAP:
        raise ValueError(f"unsupported SQL type: {sql_type}")
    return SQL_TYPE_MAP[base]
