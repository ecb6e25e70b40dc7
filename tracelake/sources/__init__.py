"""Sources: trace files, topics (Kafka or topic table), JDBC, CSV, catalog metadata."""

from tracelake.sources.catalog import columns_of, current_schema, table_exists
from tracelake.sources.csvfiles import read_csv
from tracelake.sources.jdbc import read_jdbc, write_jdbc
from tracelake.sources.logfiles import read_log_files, utf8_rejects
from tracelake.sources.topic import read_topic, read_topic_stream

__all__ = [
    "columns_of", "current_schema", "table_exists", "read_csv", "read_jdbc", "write_jdbc", "read_log_files",
    "utf8_rejects", "read_topic", "read_topic_stream",
]
