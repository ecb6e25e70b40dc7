"""End-to-end batch jobs: trace files -> topic, users table -> topic, topic -> log table.

Settings are plain arguments; a missing required setting raises before any Spark job starts.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tracelake.operators.logparse import parse_log_lines
from tracelake.operators.payload import as_topic_messages, decode, encode
from tracelake.operators.quality import validate
from tracelake.operators.ranges import merge_ranges, ranges_of
from tracelake.operators.sinks import append, ensure_table, overwrite_partition, publish, write_topic_table
from tracelake.schemas import LOG_FIELDS
from tracelake.session import path_exists, staged
from tracelake.sources.logfiles import read_log_files
from tracelake.sources.topic import read_topic, read_topic_stream
from tracelake.streaming.ingest import IngestTarget, check_target, ensure_log_tables, landing_rows, run_ingest_once


# Message size bound: below the default broker limit of about 1 MB.
MAX_MESSAGE_BYTES = 1_000_000


@dataclass
class TopicSink:
    """Either a Kafka topic (``brokers`` + ``topic``) or a topic table at ``path``."""

    topic: str
    brokers: str | None = None
    path: str | None = None
    partitions: int = 1
    options: dict = field(default_factory=dict)
    # names the append to a topic table, so that a job that is repeated does not send its rows twice
    append_id: str | None = None

    def check(self) -> None:
        if not self.topic or not (self.brokers or self.path):
            raise ValueError("topic sink needs a topic and brokers or a topic-table path")

    def send(self, messages: DataFrame) -> None:
        if self.path:
            write_topic_table(as_topic_messages(messages, self.topic, self.partitions), self.path, append_id=self.append_id)
        else:
            publish(messages, self.topic, self.brokers, self.options)


def _counter(df: DataFrame, name: str, **aggs) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    exprs = [a.alias(k) for k, a in aggs.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs


def logs_to_topic(
    spark: SparkSession,
    paths: str | Sequence[str],
    sink: TopicSink,
    *,
    chunk_rows: int = 1000,
    max_bytes: int | None = MAX_MESSAGE_BYTES,
    encoding: str = "strict",
) -> dict:
    """Parse trace files and send the rows as JSON-array messages of at most ``chunk_rows`` rows.

    Messages never mix files and keep line order. Zero parsed rows send zero messages.
    Returns run counters ``{"lines", "rows", "rejected", "messages"}`` observed during the one pass.
    """
    sink.check()
    lines = read_log_files(spark, paths, encoding=encoding)
    lines, line_obs = _counter(lines, "read", lines=F.count(F.lit(1)))
    rows = parse_log_lines(lines, keep=["file_path"])
    rows, row_obs = _counter(rows, "parsed", rows=F.count(F.lit(1)))
    messages = encode(rows, LOG_FIELDS, chunk_rows=chunk_rows, max_bytes=max_bytes, group_by=["file_path"]).drop("file_path")
    messages, msg_obs = _counter(messages, "sent", messages=F.count(F.lit(1)))
    sink.send(messages.select("chunk", "value"))
    n_lines = line_obs.get.get("lines", 0)
    n_rows = row_obs.get.get("rows", 0)
    return {"lines": n_lines, "rows": n_rows, "rejected": n_lines - n_rows, "messages": msg_obs.get.get("messages", 0)}


def table_to_topic(
    users: DataFrame, sink: TopicSink, *, chunk_rows: int = 1000, max_bytes: int | None = MAX_MESSAGE_BYTES
) -> dict:
    """Validate the users rows (fail on the first violation), then send them as ``[{"id":..,"name":..},...]``.

    Rows go out in id order (``ORDER BY ID``): consecutive id ranges per message, message ids following the order.
    Unlike the log producer, an empty table still sends one message, ``[]``. The source is read once and staged:
    validation and the sampling of id ranges work on that copy.
    """
    sink.check()
    checked = validate(staged(users.select("id", "name"), "users"), mode="fail").select("id", "name")
    messages = encode(checked, ["id", "name"], chunk_rows=chunk_rows, max_bytes=max_bytes, order_by=["id"])
    # counted after the packer: the range partitioner's sampling job re-runs the plan below the shuffle
    messages, obs = _counter(messages, "read", rows=F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint"))
    sink.send(messages.select("chunk", "value"))
    rows = obs.get.get("rows", 0)
    if rows == 0:
        spark = users.sparkSession
        sink.send(spark.createDataFrame([(0, "[]")], "chunk long, value string"))
    return {"rows": rows}


# Default bounds of one micro-batch, so a first run works a backlog off in many committed batches.
MAX_OFFSETS_PER_TRIGGER = 1_000_000
MAX_FILES_PER_TRIGGER = 1000


def topic_to_table(
    spark: SparkSession,
    topic_path: str | None,
    target: IngestTarget,
    checkpoint: str,
    *,
    brokers: str | None = None,
    topic: str | None = None,
    on_error: str = "fail",
    max_offsets_per_trigger: int | None = MAX_OFFSETS_PER_TRIGGER,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    min_partitions: int | None = None,
    options: Mapping[str, str] | None = None,
) -> dict:
    """Load every message not loaded before (checkpointed stream, ``availableNow``), then stop; returns counters.

    A micro-batch holds at most ``max_offsets_per_trigger`` messages of Kafka, or ``max_files_per_trigger`` files of a
    topic table. ``options`` go to the Kafka source as they are.
    """
    if topic_path is None and not (brokers and topic):
        raise ValueError("topic_to_table needs a topic-table path or brokers + topic")
    check_target(target, on_error)
    source = read_topic_stream(
        spark, path=topic_path, brokers=brokers, topic=topic, options=options, min_partitions=min_partitions,
        max_offsets_per_trigger=max_offsets_per_trigger, max_files_per_trigger=max_files_per_trigger,
    )
    return run_ingest_once(source, target, checkpoint, on_error=on_error)


def topic_to_table_full(spark: SparkSession, topic_path: str | None, target: IngestTarget, **kafka) -> str:
    """Batch form: re-read the whole topic and land it as one new ingest partition. Returns the ingest id."""
    ensure_log_tables(spark, target)
    messages = read_topic(spark, path=topic_path, **kafka)
    ingest = f"{target.ingest}-full-{uuid.uuid4().hex[:8]}"
    rows = landing_rows(decode(messages))
    overwrite_partition(rows, target.table, {"ingest": ingest, "batch_id": 0}, is_path=target.is_path)
    return ingest


# Fixed value: what the delete log calls the statement.
DELETE_USERS = "DELETE USERS"


def delete_with_log(
    spark: SparkSession,
    current: DataFrame,
    where,
    next_path: str,
    op_log_path: str,
    *,
    op: str = DELETE_USERS,
) -> int:
    """``DELETE FROM t WHERE cond`` plus its statement-level log row.

    Writes the next version of the table to ``next_path`` (never over the path being read), counting deleted rows
    in the same pass, then appends ``(op, happened_at, n_rows)`` to ``op_log_path`` - also when 0 rows went.
    """
    from pyspark.sql import Observation

    from tracelake.operators.quality import op_log_entry
    from tracelake.operators.tableops import delete

    obs = Observation("delete")
    delete(current, where, observation=obs).write.mode("errorifexists").parquet(next_path)
    n = int(obs.get.get("deleted") or 0)
    op_log_entry(spark, op, n).write.mode("append").parquet(op_log_path)
    return n


# Offsets loaded by batch loads: a plan is recorded before a load, the same rows with done = true after it.
LEDGER = "seq long, ingest string, topic string, partition int, first long, last long, done boolean"
# Ranges that are broadcast to the topic scan; more are joined by shuffle.
MAX_RANGES = 100_000


def _ledger(spark: SparkSession, target: IngestTarget) -> tuple[DataFrame, str]:
    name = f"{target.table.rstrip('/')}_ledger"
    if target.is_path:
        return (spark.read.schema(LEDGER).parquet(name) if path_exists(spark, name) else spark.createDataFrame([], LEDGER)), name
    ensure_table(spark, name, spark.createDataFrame([], LEDGER).schema)
    return spark.table(name), name


def _few(ranges: DataFrame) -> DataFrame:
    return F.broadcast(ranges) if ranges.limit(MAX_RANGES + 1).count() <= MAX_RANGES else ranges


def topic_to_table_incremental(spark: SparkSession, topic_path: str | None, target: IngestTarget, **kafka) -> int:
    """Batch load of only the messages not loaded yet, without a streaming checkpoint; one loader at a time.

    A small ledger beside the table says which offset ranges each load took (one row per unbroken range and load); the
    landing table is not read. What is new is what lies in none of these ranges, so a message that turns up below
    offsets already loaded is loaded, too, and a gap is never taken for loaded. A load first records its plan, then
    overwrites its own ingest partition, then records that it is done: a load that broke off is repeated with the same
    ranges into the same partition before anything new is planned. Returns the number of rows landed.
    """
    ensure_log_tables(spark, target)
    messages = read_topic(spark, path=topic_path, **kafka)
    key = ["topic", "partition"]
    landed = 0
    while True:
        ledger, name = _ledger(spark, target)
        ledger = staged(ledger, "ledger")  # the load appends to it
        done = ledger.where("done").select("seq").distinct()
        plan = ledger.where("not done").join(done, "seq", "left_anti")
        repeated = not plan.isEmpty()
        if not repeated:
            loaded = _few(merge_ranges(ledger.where("done").select(*key, "first", "last"), key))
            within = [messages[k].eqNullSafe(loaded[k]) for k in key] + [messages["offset"].between(loaded["first"], loaded["last"])]
            found = staged(ranges_of(messages.select(*key, "offset").join(loaded, within, "left_anti"), key, "offset"), "ranges")
            if found.isEmpty():
                return landed
            seq = (ledger.agg(F.max("seq")).first()[0] or 0) + 1
            ingest = f"{target.ingest}-batch-{uuid.uuid4().hex[:8]}"
            plan = found.select(F.lit(seq).cast("bigint").alias("seq"), F.lit(ingest).alias("ingest"), *key, "first", "last", F.lit(False).alias("done"))
            append(plan, name, is_path=target.is_path, required=())
        ingest = plan.first()["ingest"]
        ranges = _few(plan.select(*key, "first", "last"))
        within = [messages[k].eqNullSafe(ranges[k]) for k in key] + [messages["offset"].between(ranges["first"], ranges["last"])]
        taken = messages.join(ranges, within, "left_semi")
        rows, obs = _counter(landing_rows(decode(taken)), "landed", rows=F.count(F.lit(1)))
        overwrite_partition(rows, target.table, {"ingest": ingest, "batch_id": 0}, is_path=target.is_path)
        landed += int(obs.get.get("rows", 0))
        append(plan.withColumn("done", F.lit(True)), name, is_path=target.is_path, required=())
        if not repeated:
            return landed
