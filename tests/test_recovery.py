"""Appends and loads that break off: no offset twice, no row lost, late offsets loaded."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracelake.operators import sinks
from tracelake.operators.payload import as_topic_messages
from tracelake.operators.ranges import merge_ranges, ranges_of
from tracelake.operators.sinks import append, ensure_table, overwrite_partition, recover_topic_table, write_topic_table
from tracelake.plans.jobs import topic_to_table_incremental
from tracelake.schemas import LOG_ENTRY, TOPIC
from tracelake.streaming.ingest import IngestTarget

GOOD = '[{"timestamp":"t","level":"i","component":"c","message":"m%d"}]'


def messages(spark, ids, partitions=3):
    rows = spark.createDataFrame([(i, GOOD % i) for i in ids], "chunk long, value string")
    return as_topic_messages(rows.repartition(4), "logs", partitions)


def table(spark, path):
    return spark.read.schema(TOPIC).parquet(path)


def check(spark, path, ids):
    """Every message once, every offset once, offsets dense."""
    rows = table(spark, path).collect()
    assert sorted(bytes(r.value).decode() for r in rows) == sorted(GOOD % i for i in ids)
    got = Counter((r.partition, r.offset) for r in rows)
    assert not rows or max(got.values()) == 1
    for p in {p for p, _ in got}:
        assert sorted(o for q, o in got if q == p) == list(range(sum(q == p for q, _ in got)))


class Lost(RuntimeError):
    pass


@pytest.mark.parametrize(("breaks", "runs"), [("first note", 20_000), ("rows", 20_000), ("half the rows", 20_000), ("half the rows", 0), ("done note", 20_000)])
def test_append_that_breaks_off(spark, tmp_path, monkeypatch, breaks, runs):
    monkeypatch.setattr(sinks, "MAX_RUNS", runs)
    path = str(tmp_path / "topic")
    write_topic_table(messages(spark, range(20)), path)
    note, rows, notes = sinks._note, sinks._write_rows, []

    def broken_note(*a):
        notes.append(a)
        if breaks == "first note" or (breaks == "done note" and len(notes) == 2):
            raise Lost
        note(*a)

    def broken_rows(df, where):
        if breaks == "half the rows":
            rows(df.where(F.col("offset") % 2 == 0), where)
        if breaks in ("rows", "half the rows"):
            raise Lost
        rows(df, where)

    monkeypatch.setattr(sinks, "_note", broken_note)
    monkeypatch.setattr(sinks, "_write_rows", broken_rows)
    with pytest.raises(Lost):
        write_topic_table(messages(spark, range(20, 50)), path, append_id="second")
    monkeypatch.setattr(sinks, "_note", note)
    monkeypatch.setattr(sinks, "_write_rows", rows)
    write_topic_table(messages(spark, range(50, 60)), path)  # resolves what it finds
    noted = breaks != "first note"
    check(spark, path, [*range(20), *(range(20, 50) if noted else ()), *range(50, 60)])
    write_topic_table(messages(spark, range(20, 50)), path, append_id="second")  # repeated by its caller
    check(spark, path, range(60))
    assert recover_topic_table(spark, path) == 0


def test_recovery_alone_and_changed_staging(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "topic")
    rows = sinks._write_rows

    def lost(df, where):
        raise Lost

    monkeypatch.setattr(sinks, "_write_rows", lost)
    with pytest.raises(Lost):
        write_topic_table(messages(spark, range(30)), path)
    monkeypatch.setattr(sinks, "_write_rows", rows)
    assert recover_topic_table(spark, path) == 1 and recover_topic_table(spark, path) == 0
    check(spark, path, range(30))


def test_tables_without_a_log_go_on(spark, tmp_path):
    path = str(tmp_path / "topic")
    old = messages(spark, range(9)).withColumn("offset", F.col("offset") % 3)  # partitions 0 to 2, offsets 0 to 2
    old.coalesce(1).write.parquet(path)
    only = messages(spark, range(9, 20)).withColumn("partition", F.lit(1))
    write_topic_table(only, path)
    write_topic_table(messages(spark, range(20, 40)), path)
    check(spark, path, range(40))


def test_late_offsets_and_gaps_are_loaded(spark, tmp_path):
    path, target = str(tmp_path / "topic"), IngestTarget(str(tmp_path / "t"), "a", is_path=True)
    rows = messages(spark, range(60), 2).persist()  # offsets 0 to 29 in two partitions

    def arrive(keep):
        rows.where(keep).write.mode("append").parquet(path)
        return topic_to_table_incremental(spark, path, target)

    at = F.col("offset")
    total = rows.count()
    order = [at.between(10, 14), at > 20, at < 3, (at >= 3) & (at < 10) & (at % 2 == 0), (at >= 3) & (at < 10) & (at % 2 == 1), at.between(15, 20)]
    loaded = [arrive(k) for k in order]
    assert loaded == [rows.where(k).count() for k in order] and sum(loaded) == total
    assert topic_to_table_incremental(spark, path, target) == 0
    assert spark.read.parquet(target.table).select("src_partition", "src_offset").distinct().count() == total
    ledger = spark.read.parquet(f"{target.table}_ledger").where("done")
    whole = merge_ranges(ledger.select("topic", "partition", "first", "last"), ["topic", "partition"]).collect()
    assert len(whole) == 2 and all(r["first"] == 0 for r in whole)


@pytest.mark.parametrize("block", [4, 1_000_000])
def test_ranges(spark, block):
    numbers = {"a": [0, 1, 2, 3, 4, 5, 6, 7, 8, 20], "b": [5, 5, 6, 9, 11, 12, 13, 14, 15, 16, 17], None: [-3, -2, 0, 1]}
    df = spark.createDataFrame([(k, n) for k, ns in numbers.items() for n in ns], "k string, n long")
    got = sorted((str(r["k"]), r["first"], r["last"]) for r in ranges_of(df, ["k"], "n", block).collect())
    assert got == [("None", -3, -2), ("None", 0, 1), ("a", 0, 8), ("a", 20, 20), ("b", 5, 6), ("b", 9, 9), ("b", 11, 17)]
    assert ranges_of(df.limit(0), ["k"], "n").collect() == []


def test_null_is_refused_on_every_write(spark, tmp_path):
    good = spark.createDataFrame([("t", "i", "c", "m")], "timestamp string, level string, component string, message string")
    bad = good.withColumn("level", F.lit(None).cast("string"))
    path = str(tmp_path / "logs")
    append(good, path, is_path=True)
    for write in (lambda d: append(d, path, is_path=True), lambda d: overwrite_partition(d, path + "2", {"ingest": "a", "batch_id": 0}, is_path=True)):
        with pytest.raises(Exception, match="NULL in required column level"):
            write(bad)
    users = spark.createDataFrame([(1, None)], "id long, name string")
    append(users, str(tmp_path / "u"), is_path=True)
    with pytest.raises(Exception, match="NULL in required column name"):
        append(users, str(tmp_path / "u"), is_path=True, required=["id", "name"])
    assert spark.read.parquet(path).count() == 1


def test_null_is_refused_on_v2_writes(spark, tmp_path, monkeypatch):
    name = "default.v2_required"
    ensure_table(spark, name, LOG_ENTRY, location=str(tmp_path / "t"))
    bad = spark.createDataFrame([("t", None, "c", "m")], "timestamp string, level string, component string, message string")
    written = []

    class Writer:  # no v2 catalog here: what would be written is computed instead
        def __init__(self, df):
            self.df = df

        def append(self):
            written.append(self.df.collect())

    monkeypatch.setattr(type(bad), "writeTo", lambda self, table: Writer(self))
    with pytest.raises(Exception, match="NULL in required column level"):
        append(bad, name, v2=True)
    append(bad.fillna("i"), name, v2=True)
    assert len(written) == 1
    spark.sql(f"DROP TABLE {name}")
