"""Message topics: Kafka (when its connector is on the classpath) or a *topic table*.

A topic table is a Parquet directory with Spark's Kafka source columns (``key, value, topic, partition, offset,
timestamp, timestampType``); the file-stream source reads it incrementally, so everything downstream is the same
code for both.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tracelake.schemas import TOPIC


def _kafka_options(brokers: str, topic: str, extra: Mapping[str, str] | None) -> dict[str, str]:
    if not brokers or not topic:
        raise ValueError("Kafka source needs brokers and topic")
    opts = {"kafka.bootstrap.servers": brokers, "subscribe": topic}
    opts.update(extra or {})
    return opts


def kafka_read_options(
    brokers: str | None,
    topic: str | None,
    *,
    bounded: bool,
    options: Mapping[str, str] | None = None,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options for Spark's Kafka source: earliest start; ``bounded`` adds ``endingOffsets=latest`` (batch read)."""
    opts = {"startingOffsets": "earliest"}
    if bounded:
        opts["endingOffsets"] = "latest"
    else:
        opts["failOnDataLoss"] = "true"
        if max_offsets_per_trigger:
            opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(_kafka_options(brokers, topic, options))
    return opts


def read_topic(
    spark: SparkSession,
    *,
    path: str | None = None,
    brokers: str | None = None,
    topic: str | None = None,
    options: Mapping[str, str] | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Bounded read of a whole topic: offsets are fixed at the start (earliest .. latest), not by a clock.

    ``min_partitions`` (Kafka) splits large topic partitions into several Spark tasks, so a topic with few
    partitions still spreads over the cluster.
    """
    if path is not None:
        return spark.read.schema(TOPIC).parquet(path)
    opts = kafka_read_options(brokers, topic, bounded=True, options=options, min_partitions=min_partitions)
    return spark.read.format("kafka").options(**opts).load()


def read_topic_stream(
    spark: SparkSession,
    *,
    path: str | None = None,
    brokers: str | None = None,
    topic: str | None = None,
    options: Mapping[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Incremental read; progress lives in the query checkpoint, so each message is processed once.

    ``max_files_per_trigger`` / ``max_offsets_per_trigger`` bound a micro-batch, so a large backlog is worked off
    in several committed batches (also under ``availableNow``) instead of one huge one.
    """
    if path is not None:
        reader = spark.readStream.schema(TOPIC)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.parquet(path)
    opts = kafka_read_options(brokers, topic, bounded=False, options=options, min_partitions=min_partitions,
                              max_offsets_per_trigger=max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**opts).load()
