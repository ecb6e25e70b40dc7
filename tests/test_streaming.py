"""Exactly-once topic -> table ingestion: reruns, new data, corrupt messages (fail / quarantine), catalog target."""

import uuid

import pytest

from tracelake.operators.payload import as_topic_messages
from tracelake.operators.sinks import write_topic_table
from tracelake.schemas import LOG_FIELDS
from tracelake.sources.topic import read_topic_stream
from tracelake.streaming.ingest import IngestTarget, log_view, run_ingest_once

E = '{"timestamp":"t","level":"i","component":"c","message":"%s"}'


def _topic(spark, path, values, start=0):
    df = spark.createDataFrame([(start + i, v) for i, v in enumerate(values)], "chunk long, value string")
    write_topic_table(as_topic_messages(df.coalesce(1), "logs", 2), path)  # one file per append


def _count(spark, path):
    return spark.read.parquet(path).count()


def test_rerun_adds_nothing_then_new_data_lands(spark, tmp_path):
    topic, table, chk = str(tmp_path / "topic"), str(tmp_path / "table"), str(tmp_path / "chk")
    _topic(spark, topic, [E % i for i in range(10)])
    target = IngestTarget(table=table, ingest="a", is_path=True)
    counts = []
    for _ in range(3):
        run_ingest_once(read_topic_stream(spark, path=topic), target, chk)
        counts.append(_count(spark, table))
    _topic(spark, topic, ["[" + ",".join(E % f"n{i}" for i in range(5)) + "]"], start=100)
    run_ingest_once(read_topic_stream(spark, path=topic), target, chk)
    counts.append(_count(spark, table))
    assert counts == [10, 10, 10, 15]
    rows = spark.read.parquet(table)
    assert set(rows.columns) >= set(LOG_FIELDS) | {"src_topic", "src_partition", "src_offset", "src_pos", "ingest", "batch_id"}


def test_replayed_batch_overwrites_its_partition(spark, tmp_path):
    from tracelake.streaming.ingest import write_batch

    topic, table = str(tmp_path / "topic"), str(tmp_path / "table")
    _topic(spark, topic, [E % i for i in range(4)])
    batch = spark.read.parquet(topic)
    target = IngestTarget(table=table, ingest="x", is_path=True)
    write_batch(batch, 0, target)
    write_batch(batch, 0, target)  # crash after write, before checkpoint commit -> replay
    assert _count(spark, table) == 4


def test_corrupt_message_fail_mode_writes_nothing(spark, tmp_path):
    topic, table, chk = str(tmp_path / "topic"), str(tmp_path / "table"), str(tmp_path / "chk")
    _topic(spark, topic, [E % 1, (E % 2) + " zz", E % 3])
    target = IngestTarget(table=table, ingest="a", is_path=True)
    with pytest.raises(Exception):
        run_ingest_once(read_topic_stream(spark, path=topic), target, chk)
    import os

    written = os.path.exists(table) and any(n.startswith("ingest=") for n in os.listdir(table))
    assert not written


def test_quarantine_mode_writes_the_rest(spark, tmp_path):
    topic, table, quarantine, chk = (str(tmp_path / n) for n in ("topic", "table", "q", "chk"))
    _topic(spark, topic, [E % 1, (E % 2) + " zz", E % 3, (E % 4).replace('"level"', '"LEVEL"'), None])
    target = IngestTarget(table=table, ingest="a", is_path=True, quarantine=quarantine)
    counts = run_ingest_once(read_topic_stream(spark, path=topic), target, chk, on_error="quarantine")
    assert counts == {"batches": 1, "messages": 5, "rows": 2, "rejected": 2}  # the tombstone yields nothing
    assert sorted(r.message for r in spark.read.parquet(table).collect()) == ["1", "3"]
    assert sorted(r.reason for r in spark.read.parquet(quarantine).collect()) == ["bad_row", "malformed_json"]


def test_catalog_table_target(spark, tmp_path):
    name = f"logging_{uuid.uuid4().hex[:6]}.log_entries"
    topic, chk = str(tmp_path / "topic"), str(tmp_path / "chk")
    _topic(spark, topic, [E % i for i in range(6)])
    target = IngestTarget(table=name, ingest="cat")
    for _ in range(2):
        run_ingest_once(read_topic_stream(spark, path=topic), target, chk)
        assert spark.table(name).count() == 6  # no manual refreshTable needed
    view = log_view(spark, name, "log_entries_v")
    assert view.columns == list(LOG_FIELDS)


def test_logs_to_topic_counts_and_messages(spark, tmp_path):
    from tracelake.plans.jobs import TopicSink, logs_to_topic
    from tracelake.operators.payload import decode
    from tracelake.sources.topic import read_topic
    from test_logparse import SEVEN

    f = tmp_path / "sample.trc"
    f.write_text(SEVEN + "\n  at frame 1\n")
    topic = str(tmp_path / "topic")
    counts = logs_to_topic(spark, str(f), TopicSink(topic="logs", path=topic), chunk_rows=3)
    assert counts == {"lines": 8, "rows": 7, "rejected": 1, "messages": 3}
    back = decode(read_topic(spark, path=topic)).orderBy("offset", "pos")
    assert [r.level for r in back.collect()] == ["i", "i", "w", "e", "e", "e", "i"]


def test_multiple_micro_batches_each_own_partition(spark, tmp_path):
    topic, table, chk = str(tmp_path / "topic"), str(tmp_path / "table"), str(tmp_path / "chk")
    for k in range(3):  # three files -> three batches with maxFilesPerTrigger=1
        _topic(spark, topic, [E % f"{k}-{i}" for i in range(4)], start=10 * k)
    target = IngestTarget(table=table, ingest="mb", is_path=True)
    run_ingest_once(read_topic_stream(spark, path=topic, max_files_per_trigger=1), target, chk)
    df = spark.read.parquet(table)
    assert df.count() == 12
    assert sorted(r.batch_id for r in df.select("batch_id").distinct().collect()) == [0, 1, 2]


def test_table_to_topic_empty_table_sends_empty_array(spark, tmp_path):
    from tracelake.plans.jobs import TopicSink, table_to_topic
    from tracelake.sources.topic import read_topic

    topic = str(tmp_path / "users")
    empty = spark.createDataFrame([], "id long, name string")
    assert table_to_topic(empty, TopicSink(topic="users", path=topic)) == {"rows": 0}
    assert [bytes(r.value) for r in read_topic(spark, path=topic).collect()] == [b"[]"]


def test_full_reread_lands_one_new_ingest_partition(spark, tmp_path):
    from tracelake.plans.jobs import topic_to_table_full

    topic, table = str(tmp_path / "topic"), str(tmp_path / "table")
    _topic(spark, topic, [E % i for i in range(5)])
    target = IngestTarget(table=table, ingest="full", is_path=True)
    first = topic_to_table_full(spark, topic, target)
    second = topic_to_table_full(spark, topic, target)
    df = spark.read.parquet(table)
    assert first != second and df.count() == 10
    assert sorted(r.c for r in df.groupBy("ingest").count().withColumnRenamed("count", "c").collect()) == [5, 5]


def test_append_guard_and_targets(spark, tmp_path):
    from tracelake.operators.sinks import append, ensure_table

    rows = spark.createDataFrame([("t", "i", "c", "m")], ", ".join(f"{f} string" for f in LOG_FIELDS))
    path = str(tmp_path / "t")
    append(rows.limit(0), path, is_path=True)
    import os

    assert not os.path.exists(path)  # empty batch: target untouched
    append(rows, path, is_path=True)
    append(rows, path, is_path=True)
    assert spark.read.parquet(path).count() == 2
    from tracelake.schemas import LOG_ENTRY

    ensure_table(spark, "tl_append_t", LOG_ENTRY)
    append(rows.select("message", "level", "timestamp", "component"), "tl_append_t")  # reordered by name
    assert [tuple(r) for r in spark.table("tl_append_t").collect()] == [("t", "i", "c", "m")]


def test_topic_table_offsets_grow_across_appends(spark, tmp_path):
    topic = str(tmp_path / "topic")
    _topic(spark, topic, [E % i for i in range(4)])
    _topic(spark, topic, [E % i for i in range(4)])
    rows = spark.read.parquet(topic).select("partition", "offset").collect()
    assert len({(r.partition, r.offset) for r in rows}) == 8


def test_incremental_batch_load_skips_loaded_messages(spark, tmp_path):
    from tracelake.plans.jobs import topic_to_table_incremental

    topic, table = str(tmp_path / "topic"), str(tmp_path / "table")
    target = IngestTarget(table=table, ingest="inc", is_path=True)
    _topic(spark, topic, [E % i for i in range(6)])
    assert topic_to_table_incremental(spark, topic, target) == 6
    assert topic_to_table_incremental(spark, topic, target) == 0
    _topic(spark, topic, ["[" + E % "a" + "," + E % "b" + "]", E % "c"])
    assert topic_to_table_incremental(spark, topic, target) == 3
    assert spark.read.parquet(table).count() == 9


def test_files_per_batch(spark, tmp_path):
    import glob

    topic, table, chk = str(tmp_path / "topic"), str(tmp_path / "table"), str(tmp_path / "chk")
    df = spark.createDataFrame([(i, E % i) for i in range(40)], "chunk long, value string").repartition(5)
    write_topic_table(as_topic_messages(df, "logs", 2), topic)
    run_ingest_once(read_topic_stream(spark, path=topic), IngestTarget(table=table, ingest="f", is_path=True, files_per_batch=1), chk)
    files = glob.glob(f"{table}/ingest=f/batch_id=0/*.parquet")
    assert len(files) == 1 and spark.read.parquet(table).count() == 40
