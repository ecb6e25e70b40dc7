"""The registered query set: one Spark query per operator group, each with a DuckDB oracle.

Every query reads the driver's parquet tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.functions.logline import TRACE_PATTERN
from tracelake.functions.text import lossy_utf8, parse_unsigned, unicode_trim
from tracelake.operators import stored
from tracelake.operators.ids import insert_generated
from tracelake.operators.logparse import log_rejects, parse_log_lines, with_event_time
from tracelake.operators.payload import as_topic_messages, decode, decode_verdicts, encode, encode_each
from tracelake.operators.quality import fetch_users, role_rules, update_with_audit, validate
from tracelake.operators.sinks import (
    ALREADY_EXISTS,
    CREATED,
    add_columns,
    append,
    create_table_as,
    ensure_table,
    ensure_users_table,
    note_append,
    recover_topic_table,
    write_csv,
    write_topic_table,
)
from tracelake.operators.tableops import assign_ids, deep_page, delete, exists, insert, page, top, update, upsert
from tracelake.operators.views import (
    active_users,
    create_persistent_user_views,
    create_sql_view,
    create_user_views,
    drop_view,
    trimmed_users,
    users_count,
    users_with_roles,
)
from tracelake.plans import derive
from tracelake.plans.jobs import (
    TopicSink,
    delete_with_log,
    logs_to_topic,
    table_to_topic,
    topic_to_table,
    topic_to_table_incremental,
)
from tracelake.schemas import LOG_ENTRY, LOG_FIELDS, LOG_TABLE, LOG_TABLE_PARTITIONS, USER_ROW
from tracelake.session import scratch_path, staged
from tracelake.sources.catalog import current_schema
from tracelake.sources.csvfiles import read_csv
from tracelake.sources.logfiles import read_log_files
from tracelake.sources.topic import read_topic, read_topic_stream
from tracelake.streaming.ingest import IngestTarget, run_ingest_once

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


# ---------------------------------------------------------------------------------------------------------------
# DuckDB fragments
# ---------------------------------------------------------------------------------------------------------------

SQL_LINES = """lines AS (
  SELECT event_id,
         CASE WHEN event_id % 10 = 3 THEN concat('  at frame ', event_id)
              ELSE concat('[', user_id, ']{-1}[', event_id % 5, '/-1] ', strftime(ts, '%Y-%m-%d %H:%M:%S.%g'), ' ',
                          substr(event_type, 1, 1), ' ', upper(event_type), '    ', event_type, '.cpp(',
                          printf('%05d', event_id), ') : value=', props) END AS value
  FROM events)"""

SQL_PARSED = f"""parsed AS (
  SELECT event_id,
         regexp_extract(value, '{TRACE_PATTERN}', 1) AS timestamp,
         regexp_extract(value, '{TRACE_PATTERN}', 2) AS level,
         regexp_extract(value, '{TRACE_PATTERN}', 3) AS component,
         regexp_extract(value, '{TRACE_PATTERN}', 4) AS message
  FROM lines WHERE regexp_matches(value, '{TRACE_PATTERN}'))"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.trace_lines(derive.table(spark, sf_dir, "events"))


# ---------------------------------------------------------------------------------------------------------------
# Log parsing
# ---------------------------------------------------------------------------------------------------------------


@register(
    "log_parse",
    f"WITH {SQL_LINES}, {SQL_PARSED} SELECT timestamp, level, component, message FROM parsed",
)
def q_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_log_lines(_lines(spark, sf_dir))


@register(
    "log_rejects",
    f"WITH {SQL_LINES} SELECT value FROM lines WHERE NOT regexp_matches(value, '{TRACE_PATTERN}')",
)
def q_log_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_rejects(_lines(spark, sf_dir)).select("value")


@register(
    "log_event_time",
    f"""WITH {SQL_LINES}, {SQL_PARSED}
SELECT timestamp, level, component, message,
       try_cast(regexp_replace(timestamp, '\\s+', ' ', 'g') AS TIMESTAMP) AS event_time
FROM parsed""",
)
def q_log_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(parse_log_lines(_lines(spark, sf_dir)))


# ---------------------------------------------------------------------------------------------------------------
# Payload encode / decode
# ---------------------------------------------------------------------------------------------------------------

# Messages of the registered queries are cut by a unique sequence number so both engines agree on them.
CHUNK_ROWS = 1000
TOPIC_PARTITIONS = 4

SQL_LOG_COLS = "timestamp, level, component, message"


def _parsed_with_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_log_lines(_lines(spark, sf_dir), keep=["event_id"])


def _log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(
        _parsed_with_id(spark, sf_dir),
        LOG_FIELDS,
        chunk_by=F.expr(f"event_id div {CHUNK_ROWS}"),
        order_by=["event_id"],
        split_keys=False,
    )


@register(
    "payload_encode",
    f"""WITH {SQL_LINES}, {SQL_PARSED}
SELECT CAST(event_id // {CHUNK_ROWS} AS BIGINT) AS chunk, count(*) AS n_rows,
       CAST(to_json(list({{'timestamp': timestamp, 'level': level, 'component': component, 'message': message}}
                          ORDER BY event_id)) AS VARCHAR) AS value
FROM parsed GROUP BY 1""",
)
def q_payload_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log_messages(spark, sf_dir)


@register("payload_decode", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS} FROM parsed")
def q_payload_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = as_topic_messages(_log_messages(spark, sf_dir), "logs", TOPIC_PARTITIONS)
    return decode(topic).select(*LOG_FIELDS)


def _single_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    msgs = encode_each(_parsed_with_id(spark, sf_dir), LOG_FIELDS, keep=["event_id"])
    return msgs.withColumnRenamed("event_id", "chunk")


@register("payload_decode_single", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS} FROM parsed")
def q_payload_decode_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = as_topic_messages(_single_messages(spark, sf_dir), "logs", TOPIC_PARTITIONS)
    return decode(topic).select(*LOG_FIELDS)


def corrupted_messages(messages: DataFrame) -> DataFrame:
    """Damage every 17th message three ways: trailing text, a renamed field, a NULL value (tombstone)."""
    c = F.col("chunk") % 17
    value = (
        F.when(c == 0, F.concat(F.col("value"), F.lit(" zz")))
        .when(c == 1, F.replace(F.col("value"), F.lit('"level":'), F.lit('"LEVEL":')))
        .when(c == 2, F.lit(None).cast("string"))
        .otherwise(F.col("value"))
    )
    return messages.withColumn("value", value)


@register(
    "payload_quarantine",
    f"""WITH {SQL_LINES}, {SQL_PARSED}
SELECT CAST(event_id % {TOPIC_PARTITIONS} AS INTEGER) AS partition,
       CAST(event_id // {TOPIC_PARTITIONS} AS BIGINT) AS offset,
       CAST(CASE WHEN event_id % 17 IN (0, 1) THEN NULL ELSE 0 END AS INTEGER) AS pos,
       CASE WHEN event_id % 17 IN (0, 1) THEN 'bad' ELSE 'ok' END AS verdict,
       CASE WHEN event_id % 17 IN (0, 1) THEN NULL ELSE timestamp END AS timestamp,
       CASE WHEN event_id % 17 IN (0, 1) THEN NULL ELSE level END AS level,
       CASE WHEN event_id % 17 IN (0, 1) THEN NULL ELSE component END AS component,
       CASE WHEN event_id % 17 IN (0, 1) THEN NULL ELSE message END AS message,
       CASE event_id % 17 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'bad_row' END AS reason,
       CASE event_id % 17 WHEN 0 THEN concat(j, ' zz') WHEN 1 THEN replace(j, '"level":', '"LEVEL":') END AS value
FROM (SELECT *, CAST(to_json({{'timestamp': timestamp, 'level': level, 'component': component, 'message': message}}) AS VARCHAR) AS j
      FROM parsed) WHERE event_id % 17 <> 2""",
)
def q_payload_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = as_topic_messages(corrupted_messages(_single_messages(spark, sf_dir)), "logs", TOPIC_PARTITIONS)
    return decode_verdicts(topic).drop("topic").withColumn("value", F.col("value").cast("string"))


# ---------------------------------------------------------------------------------------------------------------
# Trace files and topics end to end
# ---------------------------------------------------------------------------------------------------------------


def _write_trace_files(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "trace-files")
    _lines(spark, sf_dir).select("value").write.text(path)
    return path


@register("log_file_parse", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS} FROM parsed")
def q_log_file_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace lines written as text files, then read back through the file source and parsed."""
    return parse_log_lines(read_log_files(spark, _write_trace_files(spark, sf_dir))).select(*LOG_FIELDS)


@register("logs_round_trip", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS} FROM parsed")
def q_logs_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace files -> positional JSON-array messages in a topic table -> strict decode."""
    files = _write_trace_files(spark, sf_dir)
    topic_path = scratch_path(spark, "logs-topic")
    logs_to_topic(spark, files, TopicSink(topic="logs", path=topic_path, partitions=TOPIC_PARTITIONS), chunk_rows=CHUNK_ROWS)
    return decode(read_topic(spark, path=topic_path)).select(*LOG_FIELDS)


@register("topic_to_table", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS} FROM parsed")
def q_topic_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the topic into the landing table twice with one checkpoint: the second run adds nothing."""
    base = scratch_path(spark, "topic-to-table")
    topic_path, table_path, checkpoint = f"{base}/topic", f"{base}/table", f"{base}/checkpoint"
    write_topic_table(as_topic_messages(_log_messages(spark, sf_dir), "logs", TOPIC_PARTITIONS), topic_path)
    target = IngestTarget(table=table_path, ingest="run", is_path=True)
    for _ in range(2):
        run_ingest_once(read_topic_stream(spark, path=topic_path), target, checkpoint)
    return spark.read.parquet(table_path).select(*LOG_FIELDS)


# ---------------------------------------------------------------------------------------------------------------
# Users and roles
# ---------------------------------------------------------------------------------------------------------------

SQL_USERS = "users AS (SELECT c_custkey AS id, c_name AS name FROM customer)"
SQL_ROLES = "roles AS (SELECT o_custkey AS user_id, o_orderpriority AS role FROM orders)"
AUDIT_TIME = "2024-05-20 12:00:00"


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.users(derive.table(spark, sf_dir, "customer"))


def _roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.roles(derive.table(spark, sf_dir, "orders"))


@register("users_scan", f"WITH {SQL_USERS} SELECT id, trim(name) AS name FROM users ORDER BY id")
def q_users_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trimmed_users(_users(spark, sf_dir)).orderBy("id")


@register("users_count", f"WITH {SQL_USERS} SELECT count(*) AS n_users FROM users")
def q_users_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_count(_users(spark, sf_dir))


# Users of whom every seventh has no name and the next an empty one.
SQL_SOME_NAMES = """some_names AS (
  SELECT id, CASE id % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE name END AS name FROM users)"""


def _some_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("id") % 7
    name = F.when(n == 0, F.lit(None)).when(n == 1, F.lit("")).otherwise(F.col("name"))
    return _users(spark, sf_dir).withColumn("name", name)


@register("users_active", f"WITH {SQL_USERS}, {SQL_SOME_NAMES} SELECT id, name FROM some_names WHERE name IS NOT NULL")
def q_users_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_users(_some_names(spark, sf_dir))


@register(
    "users_with_roles",
    f"""WITH {SQL_USERS}, {SQL_ROLES}
SELECT u.id, u.name, r.role FROM users u LEFT JOIN roles r ON r.user_id = u.id""",
)
def q_users_with_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_with_roles(_users(spark, sf_dir), _roles(spark, sf_dir))


@register("roles_of_kind", f"WITH {SQL_ROLES} SELECT user_id, role FROM roles WHERE role = '1-URGENT' AND user_id > 0")
def q_roles_of_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equality and conjunction filter; both predicates reach the scan."""
    return _roles(spark, sf_dir).where((F.col("role") == "1-URGENT") & (F.col("user_id") > 0))


@register("users_page", f"WITH {SQL_USERS} SELECT id, name FROM users ORDER BY id LIMIT 10 OFFSET 10")
def q_users_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page(_users(spark, sf_dir), ["id"], 10, 10)


@register("users_top", f"WITH {SQL_USERS} SELECT id, name FROM users ORDER BY id LIMIT 10")
def q_users_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top(_users(spark, sf_dir), ["id"], 10)


def _updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    # UPDATE users SET name = ' ' || upper(name) || ' ' WHERE name LIKE '%5', with the name normaliser (trim).
    return update(
        _users(spark, sf_dir),
        {"name": F.concat(F.lit(" "), F.upper("name"), F.lit(" "))},
        F.col("name").like("%5"),
        normalise={"name": unicode_trim},
    )


@register(
    "users_update",
    f"WITH {SQL_USERS} SELECT id, CASE WHEN name LIKE '%5' THEN trim(concat(' ', upper(name), ' ')) ELSE name END AS name FROM users",
)
def q_users_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir)


@register("users_delete", f"WITH {SQL_USERS} SELECT id, name FROM users WHERE NOT coalesce(name LIKE '%3', false)")
def q_users_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return delete(_users(spark, sf_dir), F.col("name").like("%3"))


NEW_ID_BASE = 1_000_000_000


def _user_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a change: an urgent one renames its customer, any other one names a new user."""
    o = derive.table(spark, sf_dir, "orders")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    return o.select(
        (F.col("o_custkey") + F.when(urgent, 0).otherwise(NEW_ID_BASE)).alias("id"),
        F.concat(F.when(urgent, "urgent-").otherwise("new-"), F.col("o_orderkey").cast("string")).alias("name"),
        "o_orderdate", "o_orderkey",
    )


@register(
    "users_upsert",
    f"""WITH {SQL_USERS},
changes AS (
  SELECT o_custkey AS id, concat('urgent-', o_orderkey) AS name, o_orderdate, o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_custkey + {NEW_ID_BASE} AS id, concat('new-', o_orderkey) AS name, o_orderdate, o_orderkey FROM orders
  WHERE o_orderpriority IS DISTINCT FROM '1-URGENT'),
latest AS (
  SELECT id, name FROM (
    SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM changes)
  WHERE rn = 1)
SELECT id, name FROM latest
UNION ALL
SELECT id, name FROM users WHERE id NOT IN (SELECT id FROM latest)""",
)
def q_users_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(_users(spark, sf_dir), _user_changes(spark, sf_dir), "id", order_by=["o_orderdate", "o_orderkey"])


@register(
    "users_audit",
    f"""WITH {SQL_USERS},
updated AS (SELECT id, CASE WHEN name LIKE '%5' THEN trim(concat(' ', upper(name), ' ')) ELSE name END AS name FROM users)
SELECT o.id, o.name AS old_name, n.name AS new_name, TIMESTAMP '{AUDIT_TIME}' AS changed_at
FROM users o JOIN updated n ON o.id = n.id WHERE o.name IS DISTINCT FROM n.name""",
)
def q_users_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row audit of the update, taken from the update's own projection (no join of the two versions)."""
    _, audit = update_with_audit(
        _users(spark, sf_dir),
        {"name": F.concat(F.lit(" "), F.upper("name"), F.lit(" "))},
        F.col("name").like("%5"),
        normalise={"name": unicode_trim},
        changed_at=F.lit(AUDIT_TIME).cast("timestamp_ntz"),
        only_changed=True,
    )
    return audit


def _users_to_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users plus a candidate row for every order: empty, NULL, too long names, negative and repeated ids."""
    o = derive.table(spark, sf_dir, "orders")
    p = F.col("o_orderpriority")
    cand = o.select(
        F.when(p == "4-NOT SPECIFIED", -F.col("o_orderkey")).otherwise(F.col("o_custkey")).alias("id"),
        F.when(p == "2-HIGH", F.lit(""))
        .when(p == "3-MEDIUM", F.lit(None).cast("string"))
        .when(p == "5-LOW", F.repeat(F.lit("x"), 300))
        .otherwise(F.concat(F.lit("dup-"), F.col("o_orderkey").cast("string")))
        .alias("name"),
    )
    return _users(spark, sf_dir).unionByName(cand)


@register(
    "users_validate",
    f"""WITH {SQL_USERS},
input AS (
  SELECT id, name FROM users
  UNION ALL
  SELECT CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN -o_orderkey ELSE o_custkey END AS id,
         CASE o_orderpriority WHEN '2-HIGH' THEN '' WHEN '3-MEDIUM' THEN NULL WHEN '5-LOW' THEN repeat('x', 300)
              ELSE concat('dup-', o_orderkey) END AS name
  FROM orders),
counts AS (SELECT id, count(*) AS n FROM input GROUP BY id)
SELECT i.id, i.name,
       CAST(CASE WHEN i.name IS NULL OR length(i.name) = 0 THEN 10001
                 WHEN length(i.name) > 255 THEN 10002
                 WHEN i.id IS NULL OR i.id < 0 THEN 10003
                 WHEN c.n > 1 THEN 10004 ELSE 0 END AS INTEGER) AS error_code
FROM input i LEFT JOIN counts c ON i.id = c.id""",
)
def q_users_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(_users_to_check(spark, sf_dir), mode="flag")


@register(
    "users_assign_ids",
    f"""WITH {SQL_USERS}
SELECT 'kept' AS part, id, name FROM users
UNION ALL
SELECT 'new id', (SELECT max(id) FROM users) + row_number() OVER (), NULL FROM orders
UNION ALL
SELECT 'new name', NULL, concat('new-', o_orderkey) FROM orders""",
)
def q_users_assign_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order is a user without id. Which new row gets which id is free, so new ids and new names are two parts."""
    o = derive.table(spark, sf_dir, "orders")
    new = o.select(F.lit(None).cast("bigint").alias("id"), F.concat(F.lit("new-"), F.col("o_orderkey").cast("string")).alias("name"))
    done = staged(assign_ids(_users(spark, sf_dir).unionByName(new)), "assigned")
    given = F.col("name").startswith("new-")
    none = F.lit(None)
    kept = done.where(~given).select(F.lit("kept").alias("part"), "id", "name")
    ids = done.where(given).select(F.lit("new id").alias("part"), "id", none.cast("string").alias("name"))
    return kept.unionByName(ids).unionByName(done.where(given).select(F.lit("new name").alias("part"), none.cast("bigint").alias("id"), "name"))


@register(
    "users_round_trip",
    f"WITH {SQL_USERS} SELECT id, name FROM users",
)
def q_users_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validated users -> JSON-array messages in a topic table -> strict decode with the users schema."""
    topic_path = scratch_path(spark, "users-topic")
    table_to_topic(_users(spark, sf_dir), TopicSink(topic="users", path=topic_path), chunk_rows=CHUNK_ROWS)
    return decode(read_topic(spark, path=topic_path), USER_ROW).select("id", "name")


@register(
    "csv_round_trip",
    r"""SELECT c_custkey, CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN concat(' ', c_name, '  ')
         WHEN 3 THEN concat('"', c_name, '", ""') WHEN 4 THEN concat(c_name, chr(10), chr(13), chr(10), 'x')
         WHEN 5 THEN '\N' WHEN 6 THEN concat('\\n', c_name, '\') WHEN 7 THEN concat(c_name, ',;', chr(9)) ELSE c_name END AS c_name,
         c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export to CSV and import again: NULL, empty text, outer spaces, quotes, line breaks and backslashes return."""
    n, name = F.col("c_custkey") % 9, F.col("c_name")
    hard = (
        F.when(n == 0, F.lit(None)).when(n == 1, F.lit("")).when(n == 2, F.concat(F.lit(" "), name, F.lit("  ")))
        .when(n == 3, F.concat(F.lit('"'), name, F.lit('", ""'))).when(n == 4, F.concat(name, F.lit("\n\r\nx")))
        .when(n == 5, F.lit("\\N")).when(n == 6, F.concat(F.lit("\\\\n"), name, F.lit("\\")))
        .when(n == 7, F.concat(name, F.lit(",;\t"))).otherwise(name)
    )
    customer = derive.table(spark, sf_dir, "customer").withColumn("c_name", hard)
    path = scratch_path(spark, "customer-csv")
    write_csv(customer, path)
    return read_csv(spark, path, customer.schema)


@register(
    "roles_validate",
    f"""WITH {SQL_ROLES}
SELECT user_id, role,
       CAST(CASE WHEN user_id IS NULL THEN 10013 WHEN role IS NULL THEN 10011 WHEN length(role) > 50 THEN 10012
                 ELSE 0 END AS INTEGER) AS error_code
FROM roles""",
)
def q_roles_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_roles`` constraints (both columns required, role at most 50 characters) over every order."""
    return validate(_roles(spark, sf_dir), role_rules(), unique_key=None)


@register("users_fetch", "SELECT c_custkey AS id, coalesce(trim(c_name), '') AS name FROM customer")
def q_users_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users as the table source delivers them: strict unsigned id, name trimmed, NULL name as ''."""
    customer = derive.table(spark, sf_dir, "customer")
    return fetch_users(customer, "c_custkey", "c_name")


@register(
    "users_delete_log",
    f"WITH {SQL_USERS} SELECT 'DELETE USERS' AS op, count(*) AS n_rows FROM users WHERE name LIKE '%3'",
)
def q_users_delete_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DELETE job: the next table version and its statement-level log row, counted in the same pass."""
    base = scratch_path(spark, "users-delete")
    delete_with_log(spark, _users(spark, sf_dir), F.col("name").like("%3"), f"{base}/users", f"{base}/op_log")
    return spark.read.parquet(f"{base}/op_log").select("op", "n_rows")


# ---------------------------------------------------------------------------------------------------------------
# Through the catalog
# ---------------------------------------------------------------------------------------------------------------


def _new_name(label: str) -> str:
    return f"tracelake_{label}_{uuid.uuid4().hex[:10]}"


@register("log_table_append", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS} FROM parsed UNION ALL SELECT {SQL_LOG_COLS} FROM parsed")
def q_log_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create the log table if absent (required columns), append twice through the catalog; a second create finds it."""
    name = f"default.{_new_name('log_entries')}"
    made = [ensure_table(spark, name, LOG_ENTRY, location=scratch_path(spark, "log-table")) for _ in range(2)]
    if made != [CREATED, ALREADY_EXISTS]:
        raise RuntimeError(f"unexpected outcome of table creation: {made}")
    rows = parse_log_lines(_lines(spark, sf_dir))
    append(rows, name)
    append(rows, name)
    append(rows.limit(0), name)  # an empty batch leaves the table alone
    return spark.table(name)


@register("topic_to_catalog_table", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS}, 'run' AS ingest FROM parsed")
def q_topic_to_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream a topic into a catalog table by static partition overwrite, in bounded micro-batches, twice."""
    base = scratch_path(spark, "topic-to-catalog")
    write_topic_table(as_topic_messages(_log_messages(spark, sf_dir), "logs", TOPIC_PARTITIONS), f"{base}/topic")
    name = f"default.{_new_name('landing')}"
    ensure_table(spark, name, LOG_TABLE, partition_by=LOG_TABLE_PARTITIONS, location=f"{base}/table")
    for _ in range(2):
        topic_to_table(spark, f"{base}/topic", IngestTarget(table=name, ingest="run"), f"{base}/checkpoint", max_files_per_trigger=3)
    return spark.table(name).select(*LOG_FIELDS, "ingest")


@register(
    "users_insert",
    f"""WITH {SQL_USERS} SELECT id, name FROM users
UNION ALL SELECT o_orderkey + {NEW_ID_BASE}, concat('inserted-', o_custkey) FROM orders""",
)
def q_users_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ensure the users table, insert all customers, then a row for every order, through the catalog."""
    name = f"default.{_new_name('users')}"
    ensure_users_table(spark, name, location=scratch_path(spark, "users-table"))
    append(_users(spark, sf_dir), name)
    o = derive.table(spark, sf_dir, "orders")
    new = o.select((F.col("o_orderkey") + NEW_ID_BASE).alias("id"), F.concat(F.lit("inserted-"), F.col("o_custkey").cast("string")).alias("name"))
    append(insert(spark.table(name).limit(0), new), name)
    return spark.table(name)


@register(
    "users_slice_export",
    f"WITH {SQL_USERS}, {SQL_SOME_NAMES} SELECT id, name, CAST(NULL AS VARCHAR) AS note FROM some_names WHERE name IS NOT NULL",
)
def q_users_slice_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE TABLE AS the users with a name, add a column, export to CSV and read the export."""
    name, base = f"default.{_new_name('slice')}", scratch_path(spark, "slice")
    create_table_as(spark, name, active_users(_some_names(spark, sf_dir)), location=f"{base}/table")
    add_columns(spark, name, T.StructType([T.StructField("note", T.StringType())]))
    table = spark.table(name)
    write_csv(table, f"{base}/csv")
    return read_csv(spark, f"{base}/csv", table.schema)


@register(
    "users_views",
    f"""WITH {SQL_USERS}, {SQL_ROLES}, {SQL_SOME_NAMES}
SELECT 'users' AS v, id, trim(name) AS name, NULL AS role, NULL AS n FROM some_names
UNION ALL SELECT 'active', id, name, NULL, NULL FROM some_names WHERE name IS NOT NULL
UNION ALL SELECT 'count', NULL, NULL, NULL, count(*) FROM some_names
UNION ALL SELECT 'roles', u.id, u.name, r.role, NULL FROM some_names u LEFT JOIN roles r ON r.user_id = u.id
UNION ALL SELECT 'sql', id, upper(name), NULL, NULL FROM some_names WHERE name IS NOT NULL""",
)
def q_users_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The handbook's views by name, and a view over one of them, queried in SQL."""
    p = _new_name("v") + "_"
    create_user_views(_some_names(spark, sf_dir), _roles(spark, sf_dir), prefix=p)
    create_sql_view(spark, f"{p}upper", f"SELECT id, upper(name) AS name FROM {p}users_active")
    return spark.sql(
        f"""SELECT 'users' AS v, id, name, CAST(NULL AS STRING) AS role, CAST(NULL AS BIGINT) AS n FROM {p}users
        UNION ALL SELECT 'active', id, name, NULL, NULL FROM {p}users_active
        UNION ALL SELECT 'count', NULL, NULL, NULL, n_users FROM {p}users_count
        UNION ALL SELECT 'roles', id, name, role, NULL FROM {p}users_with_roles
        UNION ALL SELECT 'sql', id, name, NULL, NULL FROM {p}upper"""
    )


@register(
    "run_counters",
    f"""WITH {SQL_LINES}, {SQL_PARSED}
SELECT (SELECT count(*) FROM lines) AS lines, (SELECT count(*) FROM parsed) AS rows,
       (SELECT count(*) FROM lines) - (SELECT count(*) FROM parsed) AS rejected,
       (SELECT count(*) FROM parsed) AS landed, EXISTS (SELECT 1 FROM parsed WHERE level = 'c') AS has_level_c,
       EXISTS (SELECT 1 FROM parsed WHERE level = '?') AS has_unknown""",
)
def q_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the jobs count while they run, and existence tests on what they landed."""
    base = scratch_path(spark, "run-counters")
    sent = logs_to_topic(spark, _write_trace_files(spark, sf_dir), TopicSink(topic="logs", path=f"{base}/topic"), chunk_rows=CHUNK_ROWS)
    target = IngestTarget(table=f"{base}/table", ingest="run", is_path=True)
    got = topic_to_table(spark, f"{base}/topic", target, f"{base}/checkpoint")
    landed = spark.read.parquet(f"{base}/table")
    row = (sent["lines"], sent["rows"], sent["rejected"], got["rows"], exists(landed, "level = 'c'"), exists(landed, "level = '?'"))
    return spark.createDataFrame([row], "lines long, rows long, rejected long, landed long, has_level_c boolean, has_unknown boolean")


@register(
    "users_audit_all",
    f"""WITH {SQL_USERS}
SELECT id, name AS old_name, CASE WHEN id % 2 = 0 THEN name ELSE concat(name, '!') END AS new_name, TIMESTAMP '{AUDIT_TIME}' AS changed_at
FROM users WHERE name LIKE '%5'""",
)
def q_users_audit_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row audit as documented: every row that the update hits, whether or not its value changes."""
    _, audit = update_with_audit(
        _users(spark, sf_dir),
        {"name": F.when(F.col("id") % 2 == 0, F.col("name")).otherwise(F.concat(F.col("name"), F.lit("!")))},
        F.col("name").like("%5"),
        changed_at=F.lit(AUDIT_TIME).cast("timestamp_ntz"),
    )
    return audit


@register("topic_to_table_batches", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS} FROM parsed")
def q_topic_to_table_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appends to a topic, of which the second breaks off half-way, and a load after each.

    The load behind the broken append takes the rows that are there; the third append first carries the broken one
    through, so rows appear at offsets below loaded ones, and the next load takes these and the new ones. A last load
    finds nothing.
    """
    base = scratch_path(spark, "topic-batches")
    target = IngestTarget(table=f"{base}/table", ingest="run", is_path=True)
    messages = _log_messages(spark, sf_dir)
    for third in (0, 1, 2):
        part = as_topic_messages(messages.where(F.col("chunk") % 3 == third), "logs", TOPIC_PARTITIONS)
        if third == 1:
            noted = note_append(part, f"{base}/topic")
            if noted:
                noted[0].where(F.col("offset") % 2 == 1).write.mode("append").parquet(f"{base}/topic")
        else:
            write_topic_table(part, f"{base}/topic")
        topic_to_table_incremental(spark, f"{base}/topic", target)
    recover_topic_table(spark, f"{base}/topic")
    topic_to_table_incremental(spark, f"{base}/topic", target)
    return spark.read.parquet(target.table).select(*LOG_FIELDS)


@register("topic_late_offsets", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS}, count(*) OVER () AS landed FROM parsed")
def q_topic_late_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that arrive out of the order of their offsets: each load takes what lies in no range loaded before."""
    base = scratch_path(spark, "topic-late")
    target = IngestTarget(table=f"{base}/table", ingest="run", is_path=True)
    messages = staged(as_topic_messages(_log_messages(spark, sf_dir), "logs", TOPIC_PARTITIONS), "late")
    landed = 0
    for turn in (2, 0, 1):
        messages.where(F.col("offset") % 3 == turn).write.mode("append").parquet(f"{base}/topic")
        landed += topic_to_table_incremental(spark, f"{base}/topic", target)
    landed += topic_to_table_incremental(spark, f"{base}/topic", target)
    return spark.read.parquet(target.table).select(*LOG_FIELDS, F.lit(landed).cast("bigint").alias("landed"))


# ---------------------------------------------------------------------------------------------------------------
# Stored tables: changes that last, keys checked against the table, generated ids, deep pages, persistent views
# ---------------------------------------------------------------------------------------------------------------

STORED_BUCKETS = 16


def _stored_users(spark: SparkSession, sf_dir: str, label: str) -> str:
    name = f"default.{_new_name(label)}"
    stored.create(spark, name, USER_ROW, "id", buckets=STORED_BUCKETS, location=scratch_path(spark, label))
    stored.insert(spark, name, _users(spark, sf_dir))
    return name


@register(
    "users_stored_changes",
    f"""WITH {SQL_USERS},
updated AS (SELECT id, CASE WHEN name LIKE '%5' THEN trim(concat(' ', upper(name), ' ')) ELSE name END AS name FROM users),
changes AS (
  SELECT o_custkey + CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE {NEW_ID_BASE} END AS id,
         concat(CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent-' ELSE 'new-' END, o_orderkey) AS name, o_orderdate, o_orderkey
  FROM orders),
latest AS (
  SELECT id, name FROM (
    SELECT id, name, row_number() OVER (PARTITION BY id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM changes)
  WHERE rn = 1),
upserted AS (SELECT id, name FROM latest UNION ALL SELECT id, name FROM updated WHERE id NOT IN (SELECT id FROM latest))
SELECT id, name FROM upserted WHERE name NOT LIKE '%3'""",
)
def q_users_stored_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored users table that is updated, upserted and deleted from in turn, then read by its name."""
    name = _stored_users(spark, sf_dir, "users_stored")
    renamed = {"name": F.concat(F.lit(" "), F.upper("name"), F.lit(" "))}
    stored.update(spark, name, renamed, F.col("name").like("%5"), normalise={"name": unicode_trim})
    stored.upsert(spark, name, _user_changes(spark, sf_dir), order_by=["o_orderdate", "o_orderkey"])
    stored.delete(spark, name, F.col("name").like("%3"))
    return spark.table(name)


@register(
    "users_insert_missing_columns",
    f"""WITH {SQL_USERS} SELECT id, name FROM users
UNION ALL SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey + {NEW_ID_BASE} END, NULL FROM orders""",
)
def q_users_insert_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT by column name into the users: a row for every order, without a name and every second without an id."""
    o = derive.table(spark, sf_dir, "orders")
    return insert(_users(spark, sf_dir), o.select(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey") + NEW_ID_BASE).alias("id")))


@register(
    "users_audit_now",
    f"""WITH {SQL_USERS}
SELECT id, name AS old_name, concat(name, '!') AS new_name, true AS now, true AS one_time, true AS in_schema FROM users""",
)
def q_users_audit_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row audit stamped by CURRENT_TIMESTAMP: one time for the statement, that of its run, in the current schema."""
    begun = datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(seconds=1)
    _, audit = update_with_audit(_users(spark, sf_dir), {"name": F.concat("name", F.lit("!"))})
    audit = staged(audit, "audit-now")
    ended = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(seconds=1)
    low, high = audit.agg(F.min("changed_at"), F.max("changed_at")).first()
    schema = F.lit(current_schema(spark)) == F.current_schema()
    at = F.col("changed_at").between(F.lit(begun).cast("timestamp_ntz"), F.lit(ended).cast("timestamp_ntz"))
    return audit.select("id", "old_name", "new_name", at.alias("now"), F.lit(low == high).alias("one_time"), schema.alias("in_schema"))


@register(
    "users_insert_checked",
    f"""WITH {SQL_USERS},
batch AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE {NEW_ID_BASE} + o_orderkey // 2 END AS id,
         concat('order-', o_orderkey) AS name FROM orders),
counts AS (SELECT id, count(*) AS n FROM batch GROUP BY id)
SELECT b.id, b.name, CAST(CASE WHEN c.n > 1 OR b.id IN (SELECT id FROM users) THEN 10004 ELSE 0 END AS INTEGER) AS error_code
FROM batch b JOIN counts c ON b.id = c.id""",
)
def q_users_insert_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a candidate row of the stored users table: ids that exist there, or twice in the batch, are flagged."""
    name = _stored_users(spark, sf_dir, "users_checked")
    o = derive.table(spark, sf_dir, "orders")
    new_id = F.lit(NEW_ID_BASE) + F.expr("o_orderkey div 2")
    batch = o.select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).otherwise(new_id).alias("id"),
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("name"),
    )
    return stored.flag_existing(spark, name, batch)


@register(
    "users_insert_generated",
    f"""WITH {SQL_USERS}
SELECT 'kept' AS part, id, name FROM users
UNION ALL
SELECT 'new id', (SELECT max(id) FROM users) + row_number() OVER (), NULL FROM orders
UNION ALL
SELECT 'new name', NULL, concat('new-', o_orderkey) FROM orders""",
)
def q_users_insert_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a user without id, inserted in two batches into the stored, filled table with reserved ids."""
    name = _stored_users(spark, sf_dir, "users_generated")
    ledger = scratch_path(spark, "users-ids")
    o = derive.table(spark, sf_dir, "orders")
    new = o.select(F.concat(F.lit("new-"), F.col("o_orderkey").cast("string")).alias("name"))
    for half in (0, 1):
        insert_generated(spark, name, new.where(F.pmod(F.hash("name"), F.lit(2)) == half), ledger)
    done, none = spark.table(name), F.lit(None)
    given = F.col("name").startswith("new-")
    kept = done.where(~given).select(F.lit("kept").alias("part"), "id", "name")
    ids = done.where(given).select(F.lit("new id").alias("part"), "id", none.cast("string").alias("name"))
    return kept.unionByName(ids).unionByName(done.where(given).select(F.lit("new name").alias("part"), none.cast("bigint").alias("id"), "name"))


@register(
    "orders_deep_page",
    """SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey) AS rn, count(*) OVER () AS n FROM orders)
WHERE rn > n * 3 // 4 AND rn <= n * 3 // 4 + 1000""",
)
def q_orders_deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of 1,000 orders behind three quarters of all: ranges before it are skipped by their counts."""
    o = derive.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    return deep_page(o, [F.col("o_orderdate").desc(), "o_orderkey"], 1000, o.count() * 3 // 4)


@register(
    "users_views_persistent",
    f"""WITH {SQL_USERS}, {SQL_ROLES}, {SQL_SOME_NAMES}
SELECT 'before' AS v, id, trim(name) AS name, NULL AS role, NULL AS n FROM some_names WHERE name IS NOT NULL
UNION ALL SELECT 'count', NULL, NULL, NULL, count(*) FROM some_names
UNION ALL SELECT 'after', id, upper(name), NULL, NULL FROM some_names WHERE name IS NOT NULL AND id % 2 = 0
UNION ALL SELECT 'roles', u.id, upper(u.name), r.role, NULL FROM some_names u LEFT JOIN roles r ON r.user_id = u.id WHERE u.id % 2 = 0""",
)
def q_users_views_persistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog views over stored tables: the base view is replaced while others depend on it, then all are dropped."""
    base, p = scratch_path(spark, "views"), f"default.{_new_name('pv')}_"
    create_table_as(spark, f"{p}t_users", _some_names(spark, sf_dir), location=f"{base}/users")
    create_table_as(spark, f"{p}t_roles", _roles(spark, sf_dir), location=f"{base}/roles")
    names = create_persistent_user_views(spark, f"{p}t_users", f"{p}t_roles", prefix=p)
    none = "CAST(NULL AS STRING) AS role, CAST(NULL AS BIGINT) AS n"
    out = spark.sql(f"SELECT 'before' AS v, id, name, {none} FROM {p}users_active")
    out = out.union(spark.sql(f"SELECT 'count', NULL, NULL, NULL, n_users FROM {p}users_count"))
    create_sql_view(spark, f"{p}users", f"SELECT id, upper(name) AS name FROM {p}t_users WHERE id % 2 = 0", temporary=False)
    out = out.union(spark.sql(f"SELECT 'after', id, name, NULL, NULL FROM {p}users_active"))
    out = out.union(spark.sql(f"SELECT 'roles', id, name, role, NULL FROM {p}users_with_roles"))
    for name in reversed(names):
        drop_view(spark, name, temporary=False)
    return out


@register("users_slice_ordered", f"WITH {SQL_USERS}, {SQL_SOME_NAMES} SELECT id, name, true AS in_order FROM some_names")
def q_users_slice_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CREATE TABLE AS all users ORDER BY ID, exported as CSV in that order: no file starts before the one in front ends."""
    name, base = f"default.{_new_name('ordered')}", scratch_path(spark, "ordered")
    create_table_as(spark, name, _some_names(spark, sf_dir), location=f"{base}/table", order_by=["id"])
    write_csv(spark.table(name), f"{base}/csv", order_by=["id"])
    rows = read_csv(spark, f"{base}/csv", spark.table(name).schema).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    rows = staged(rows, "ordered")
    spans = rows.groupBy("file").agg(F.min("id").alias("low"), F.max("id").alias("high"))  # one row per file
    before = F.max("high").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    wrong = spans.withColumn("before", before).where(F.col("low") < F.col("before")).select("file").withColumn("wrong", F.lit(True))
    return rows.join(wrong, "file", "left").select("id", "name", F.col("wrong").isNull().alias("in_order"))


@register("payload_keyed_round_trip", f"WITH {SQL_LINES}, {SQL_PARSED} SELECT {SQL_LOG_COLS} FROM parsed")
def q_payload_keyed_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per component, of which there are few: a hot key is cut into many bounded messages."""
    rows = _parsed_with_id(spark, sf_dir)
    messages = encode(rows, LOG_FIELDS, chunk_by=F.pmod(F.hash("component"), F.lit(1000)), order_by=["event_id"], chunk_rows=CHUNK_ROWS)
    return decode(as_topic_messages(messages, "logs", TOPIC_PARTITIONS)).select(*LOG_FIELDS)


@register(
    "users_fetch_dirty",
    """SELECT c_custkey AS id, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN '' ELSE c_name END AS name FROM customer""",
)
def q_users_fetch_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells as a text driver delivers them: ids with white space around, names NULL, blank or with Unicode spaces around."""
    n, name = F.col("c_custkey") % 5, F.col("c_name")
    cells = derive.table(spark, sf_dir, "customer").select(
        F.concat(F.when(n == 2, F.lit("\u2003\t")).otherwise(F.lit("")), F.col("c_custkey").cast("string"), F.lit(" \n")).alias("ID"),
        F.when(n == 0, F.lit(None)).when(n == 1, F.lit(" \u00a0\u2009")).when(n == 2, F.concat(F.lit("\u3000"), name, F.lit("\r\n"))).otherwise(name).alias("NAME"),
    )
    return fetch_users(cells)


@register(
    "users_parse_ids",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (0, 1) THEN o_custkey END AS id,
       CASE WHEN o_orderkey % 3 = 0 THEN concat(o_orderpriority, chr(65533), '!') ELSE o_orderpriority END AS name FROM orders""",
)
def q_users_parse_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text ids that are no unsigned numbers become NULL, bytes that are no UTF-8 become U+FFFD."""
    o, n = derive.table(spark, sf_dir, "orders"), F.col("o_orderkey") % 6
    key = F.col("o_custkey").cast("string")
    text = (
        F.when(n == 0, key).when(n == 1, F.concat(F.lit(" "), key, F.lit("\u2003"))).when(n == 2, F.concat(F.lit("-"), key))
        .when(n == 3, F.lit("")).when(n == 4, F.concat(key, F.lit("x"))).otherwise(F.lit("99999999999999999999"))
    )
    raw = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.col("o_orderpriority").cast("binary"), F.unhex(F.lit("FF21")))).otherwise(F.col("o_orderpriority").cast("binary"))
    return o.select("o_orderkey", parse_unsigned(text).alias("id"), lossy_utf8(raw).alias("name"))
