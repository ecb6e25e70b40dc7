"""What must never happen: lost messages, colliding offsets, unbounded messages, repeated reads, skipped checks."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracelake import session
from tracelake.operators import sinks
from tracelake.operators.logparse import log_rejects
from tracelake.operators.payload import as_topic_messages, decode, encode
from tracelake.operators.quality import fetch_users
from tracelake.operators.sinks import append, ensure_table, write_csv, write_topic_table
from tracelake.operators.tableops import upsert
from tracelake.plans.jobs import TopicSink, table_to_topic, topic_to_table, topic_to_table_incremental
from tracelake.schemas import LOG_ENTRY, TOPIC, USER_ROW
from tracelake.sources.csvfiles import read_csv
from tracelake.streaming.ingest import IngestTarget, start_ingest, write_batch

GOOD = '[{"timestamp":"t","level":"i","component":"c","message":"m"}]'


def topic_rows(spark, values, start=0):
    rows = [(None, None if v is None else v.encode(), "logs", 0, start + i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, TOPIC)


def test_quarantine_needs_a_target_and_keeps_payloads(spark, tmp_path):
    bad = ["[1]", "{", GOOD]
    with pytest.raises(ValueError, match="quarantine"):
        write_batch(topic_rows(spark, bad), 0, IngestTarget(str(tmp_path / "t"), "a", is_path=True), "quarantine")
    stream = spark.readStream.schema(TOPIC).parquet(str(tmp_path))
    with pytest.raises(ValueError, match="quarantine"):
        start_ingest(stream, IngestTarget(str(tmp_path / "t"), "a", is_path=True), str(tmp_path / "c"), on_error="quarantine")
    target = IngestTarget(str(tmp_path / "t"), "a", is_path=True, quarantine=str(tmp_path / "q"))
    got = write_batch(topic_rows(spark, bad), 0, target, "quarantine")
    assert got == {"messages": 3, "rows": 1, "rejected": 2}
    assert sorted(bytes(r.value).decode() for r in spark.read.parquet(target.quarantine).collect()) == ["[1]", "{"]


def test_hot_chunk_is_cut(spark):
    rows = spark.range(300_000).select(F.lit(7).alias("k"), F.col("id"), F.lit("n").alias("name"))
    got = encode(rows, ["id", "name"], chunk_by=F.col("k"), order_by=["id"], chunk_rows=1000).select("chunk", "n_rows", F.length("value").alias("b")).collect()
    assert sum(r.n_rows for r in got) == 300_000 and max(r.n_rows for r in got) <= 1000 and {r.chunk for r in got} == {7}
    small = encode(rows.limit(5000), ["id", "name"], chunk_by=F.col("k"), order_by=["id"], max_bytes=2000)
    assert max(r.b for r in small.select(F.length("value").alias("b")).collect()) <= 2000
    parts = [json.loads(r.value) for r in small.collect()]
    assert sorted(e["id"] for p in parts for e in p) == list(range(5000))
    assert all([e["id"] for e in p] == sorted(e["id"] for e in p) for p in parts)


def test_hot_order_value_is_split(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("id"), F.col("id").cast("string").alias("name"))
        got = encode(rows, ["id", "name"], order_by=["id"], chunk_rows=1000).groupBy(F.shiftright("chunk", 33)).agg(F.sum("n_rows").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r.n for r in got) == 60_000 and max(r.n for r in got) < 15_000


@pytest.mark.parametrize(("partitions", "runs"), [(1, 20_000), (3, 20_000), (3, 0)])
def test_offsets_never_collide(spark, tmp_path, partitions, runs, monkeypatch):
    monkeypatch.setattr(sinks, "MAX_RUNS", runs)
    ids = [((1 << 20) + i) * (1 << 33) + j for i in range(4) for j in range(5)]
    msgs = spark.createDataFrame([(i, "[]") for i in ids], "chunk long, value string")
    rows = as_topic_messages(msgs, "logs", partitions)
    assert rows.select("partition", "offset").distinct().count() == len(ids)
    path = str(tmp_path / "topic")
    grouped = msgs.withColumn("chunk", F.col("chunk") % 4)  # ids repeat, as those of grouped keyed messages do
    for m in (msgs, grouped, msgs, msgs.limit(0), grouped):
        write_topic_table(as_topic_messages(m.repartition(3), "logs", partitions), path)
    table = spark.read.schema(TOPIC).parquet(path)
    got = Counter((r.topic, r.partition, r.offset) for r in table.collect())
    assert len(got) == 4 * len(ids) and max(got.values()) == 1
    tops = {p: max(o for _, q, o in got if q == p) + 1 for p in {k[1] for k in got}}
    assert sum(tops.values()) == 4 * len(ids)  # dense: many appends do not use numbers up


def test_csv_keeps_every_value(spark, tmp_path):
    values = [None, "", " ", " x ", "\ty\t", '"', 'a"b', "a\nb", "\r\n", "\\N", "\\", "\\\\n", "\\n", "a,b", "N", "é "]
    df = spark.createDataFrame([(i, v, None if i % 2 else i) for i, v in enumerate(values)], "i int, v string, n int")
    write_csv(df, str(tmp_path / "csv"))
    got = read_csv(spark, str(tmp_path / "csv"), df.schema).orderBy("i").collect()
    assert [r.v for r in got] == values and [r.n for r in got] == [None if i % 2 else i for i in range(len(values))]
    lines = spark.read.text(str(tmp_path / "csv")).count()
    assert lines >= len(values) and sinks.CSV_NULL == "\\N"


def test_fetch_fails_whatever_is_selected(spark):
    bad = spark.createDataFrame([("1", "a"), ("abc", "b")], "ID string, NAME string")
    for use in (lambda d: d.count(), lambda d: d.select("name").collect(), lambda d: d.collect()):
        with pytest.raises(Exception, match="bad ID: abc"):
            use(fetch_users(bad))
    ok = spark.createDataFrame([(" 7 ", " n ")], "ID string, NAME string")
    assert [tuple(r) for r in fetch_users(ok).collect()] == [(7, "n")]


def test_decode_fails_whatever_is_selected(spark):
    for bad in ("[1]", "{", GOOD[:-1] + ',{"level":"i"}]'):
        with pytest.raises(Exception, match="bad message at"):
            decode(topic_rows(spark, [GOOD, bad])).count()
    assert decode(topic_rows(spark, [GOOD, None, "[]"])).count() == 1


def test_null_line_is_a_reject(spark):
    lines = spark.createDataFrame([(None,), ("x",)], "value string")
    assert log_rejects(lines).count() == 2


def test_table_is_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    users = spark.range(500).select("id", F.lit("n").alias("name")).mapInArrow(counted, USER_ROW)
    assert table_to_topic(users, TopicSink(topic="users", path=str(tmp_path / "t")), chunk_rows=100) == {"rows": 500}
    assert seen.value == 500
    assert decode(spark.read.schema(TOPIC).parquet(str(tmp_path / "t")), USER_ROW).count() == 500


def test_job_works_in_bounded_batches(spark, tmp_path):
    path = str(tmp_path / "topic")
    for i in range(5):
        write_topic_table(topic_rows(spark, [GOOD]).coalesce(1), path)
    target = IngestTarget(str(tmp_path / "t"), "a", is_path=True)
    got = topic_to_table(spark, path, target, str(tmp_path / "c"), max_files_per_trigger=2)
    assert got["messages"] == 5 and got["batches"] >= 3
    with pytest.raises(ValueError, match="quarantine"):
        topic_to_table(spark, path, target, str(tmp_path / "c2"), on_error="quarantine")


def test_broken_batch_load_is_repeated_not_doubled(spark, tmp_path, monkeypatch):
    from tracelake.plans import jobs

    path, target = str(tmp_path / "topic"), IngestTarget(str(tmp_path / "t"), "a", is_path=True)
    write_topic_table(topic_rows(spark, [GOOD] * 3), path)
    assert topic_to_table_incremental(spark, path, target) == 3
    write_topic_table(topic_rows(spark, [GOOD] * 2), path)
    real, calls = jobs.append, []

    def broken(df, name, **kw):  # the load lands its rows but breaks off before it says so
        calls.append(name)
        if len(calls) == 2:
            raise RuntimeError("lost driver")
        return real(df, name, **kw)

    monkeypatch.setattr(jobs, "append", broken)
    with pytest.raises(RuntimeError):
        topic_to_table_incremental(spark, path, target)
    monkeypatch.setattr(jobs, "append", real)
    write_topic_table(topic_rows(spark, [GOOD]), path)
    assert topic_to_table_incremental(spark, path, target) == 3  # two repeated, one new
    assert topic_to_table_incremental(spark, path, target) == 0
    assert spark.read.parquet(target.table).count() == 6


def test_required_columns(spark, tmp_path):
    name = "default.required_columns"
    ensure_table(spark, name, LOG_ENTRY, location=str(tmp_path / "t"))
    rows = spark.createDataFrame([("t", "i", "c", "m")], "timestamp string, level string, component string, message string")
    append(rows, name)
    with pytest.raises(Exception, match="NULL in required column level"):
        append(rows.withColumn("level", F.lit(None).cast("string")), name)
    assert spark.table(name).count() == 1 and sinks._ddl(LOG_ENTRY).count("NOT NULL") == 4
    spark.sql(f"DROP TABLE {name}")


def test_upsert_forms_agree(spark):
    current = spark.createDataFrame([(i, f"n{i}") for i in range(50)] + [(None, "x")], "id int, name string")
    changes = spark.createDataFrame([(i % 70, f"c{i}", i) for i in range(0, 200, 3)], "id int, name string, at int")
    a = upsert(current, changes, "id", order_by=["at"])
    b = upsert(current, changes, "id", order_by=["at"], few_changes=True)
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_shared_folder_is_required_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return "spark://h:7077" if key == "spark.master" else default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
