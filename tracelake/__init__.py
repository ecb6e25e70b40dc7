"""tracelake: land and query operational trace logs and small reference tables with PySpark.

Everything is DataFrame in, DataFrame out. Sub-packages:

* ``sources``   - log files, topic tables / Kafka, JDBC, CSV, catalog metadata
* ``functions`` - Column expressions (trace-line pattern, strict JSON checks, text helpers)
* ``operators`` - log parsing, payload encode/decode, table changes, quality checks, joins, sinks
* ``plans``     - end-to-end batch jobs and the registered query set
* ``streaming`` - exactly-once topic -> table ingestion with Structured Streaming
"""

__version__ = "0.1.0"
