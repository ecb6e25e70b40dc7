"""Command line: the three jobs as ``python -m tracelake <command>`` or ``spark-submit tracelake/cli.py <command>``.

Settings are flags; ``--brokers`` and ``--topic`` fall back to ``KAFKA_BROKERS`` / ``KAFKA_TOPIC``. Every setting is
checked before a Spark session is created; any error prints to stderr and exits with status 1.
"""

from __future__ import annotations

import argparse
import hashlib
import json
import os
import sys
from collections.abc import Sequence


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tracelake")
    sub = p.add_subparsers(dest="command", required=True)

    def topic_args(sp: argparse.ArgumentParser) -> None:
        sp.add_argument("--brokers", default=os.environ.get("KAFKA_BROKERS"))
        sp.add_argument("--topic", default=os.environ.get("KAFKA_TOPIC"))
        sp.add_argument("--topic-path", help="topic table (Parquet with the Kafka columns) instead of Kafka")
        sp.add_argument("--topic-partitions", type=int, default=1)
        sp.add_argument("--max-bytes", type=int, default=1_000_000, help="message size bound (bytes)")

    a = sub.add_parser("logs-to-topic", help="parse trace files and send the rows as JSON-array messages")
    a.add_argument("--log-file", action="append", required=True, help="file, directory or glob; repeatable")
    a.add_argument("--chunk-rows", type=int, default=1000)
    a.add_argument("--encoding", choices=("strict", "lossy", "none"), default="strict")
    topic_args(a)

    b = sub.add_parser("table-to-topic", help="send a users table (id, name) as JSON-array messages")
    b.add_argument("--table", help="catalog table")
    b.add_argument("--jdbc-url")
    b.add_argument("--jdbc-table")
    b.add_argument("--partition-column")
    b.add_argument("--lower-bound", type=int)
    b.add_argument("--upper-bound", type=int)
    b.add_argument("--num-partitions", type=int)
    b.add_argument("--chunk-rows", type=int, default=1000)
    topic_args(b)

    c = sub.add_parser("topic-to-table", help="load new messages into the log table exactly once")
    c.add_argument("--table", help="catalog table, e.g. logging.log_entries")
    c.add_argument("--table-path", help="Parquet path instead of a catalog table")
    c.add_argument("--checkpoint", required=True)
    c.add_argument("--ingest", default=None, help="partition label of this checkpoint (default: made from its path)")
    c.add_argument("--on-error", choices=("fail", "quarantine"), default="fail")
    c.add_argument("--quarantine", help="table or path for rejected messages (quarantine mode)")
    c.add_argument("--max-offsets-per-trigger", type=int, default=1_000_000, help="Kafka messages in one micro-batch")
    c.add_argument("--max-files-per-trigger", type=int, default=1000, help="topic-table files in one micro-batch")
    c.add_argument("--min-partitions", type=int, help="split Kafka partitions into at least so many tasks")
    c.add_argument("--kafka-option", action="append", default=[], metavar="NAME=VALUE", help="option of the Kafka source; repeatable")
    c.add_argument("--files-per-batch", type=int, help="files written per micro-batch (default: one per task)")
    topic_args(c)
    return p


def _check_topic(args: argparse.Namespace) -> None:
    if not args.topic_path and not (args.brokers and args.topic):
        raise ValueError("set --brokers and --topic (or KAFKA_BROKERS / KAFKA_TOPIC), or --topic-path")


def _sink(args: argparse.Namespace):
    from tracelake.plans.jobs import TopicSink

    return TopicSink(topic=args.topic or "topic", brokers=args.brokers, path=args.topic_path,
                     partitions=args.topic_partitions)


def run(argv: Sequence[str] | None = None) -> dict:
    """Parse flags, check settings, run the job; returns its counters. Raises on error."""
    args = _parser().parse_args(argv)
    _check_topic(args)
    if args.command == "table-to-topic" and not (args.table or (args.jdbc_url and args.jdbc_table)):
        raise ValueError("set --table or --jdbc-url and --jdbc-table")
    if args.command == "topic-to-table" and not (args.table or args.table_path):
        raise ValueError("set --table or --table-path")
    if args.command == "topic-to-table" and args.on_error == "quarantine" and not args.quarantine:
        raise ValueError("--on-error quarantine needs --quarantine")

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName(f"tracelake {args.command}").getOrCreate()

    if args.command == "logs-to-topic":
        from tracelake.plans.jobs import logs_to_topic

        return logs_to_topic(spark, args.log_file, _sink(args), chunk_rows=args.chunk_rows, max_bytes=args.max_bytes,
                             encoding=args.encoding)

    if args.command == "table-to-topic":
        from tracelake.operators.quality import fetch_users
        from tracelake.plans.jobs import table_to_topic
        from tracelake.sources.jdbc import read_jdbc

        if args.table:
            src = spark.table(args.table)
        else:
            src = read_jdbc(spark, args.jdbc_url, args.jdbc_table, partition_column=args.partition_column,
                            lower_bound=args.lower_bound, upper_bound=args.upper_bound,
                            num_partitions=args.num_partitions)
        cols = {c.lower(): c for c in src.columns}
        users = fetch_users(src, cols.get("id", "id"), cols.get("name", "name"))
        return table_to_topic(users, _sink(args), chunk_rows=args.chunk_rows, max_bytes=args.max_bytes)

    from tracelake.plans.jobs import topic_to_table
    from tracelake.streaming.ingest import IngestTarget

    ingest = args.ingest or ingest_label(args.checkpoint)
    target = IngestTarget(table=args.table_path or args.table, ingest=ingest, is_path=bool(args.table_path),
                          quarantine=args.quarantine, files_per_batch=args.files_per_batch)
    counts = topic_to_table(spark, args.topic_path, target, args.checkpoint, brokers=args.brokers, topic=args.topic,
                            on_error=args.on_error, max_offsets_per_trigger=args.max_offsets_per_trigger,
                            max_files_per_trigger=args.max_files_per_trigger, min_partitions=args.min_partitions,
                            options=dict(o.split("=", 1) for o in args.kafka_option))
    return {"ingest": ingest, **counts}


def ingest_label(checkpoint: str) -> str:
    """Name of a checkpoint's batches in the table: its last path part and a hash of the whole path.

    Two checkpoints of one last part both count their batches from 0; without the hash one would overwrite the other's.
    """
    path = checkpoint.rstrip("/")
    return f"{path.rsplit('/', 1)[-1]}-{hashlib.sha256(path.encode()).hexdigest()[:12]}"


def main(argv: Sequence[str] | None = None) -> int:
    try:
        print(json.dumps(run(argv)))
        return 0
    except SystemExit:
        raise
    except Exception as e:  # report and fail the process, as every job does
        print(f"tracelake: {e}", file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
