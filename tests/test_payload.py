"""Payload encode/decode: strict verdict table, fail mode, users message shape, round trips across chunk sizes."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tracelake.operators.logparse import parse_log_lines
from tracelake.operators.payload import as_topic_messages, decode, decode_verdicts, encode, encode_each
from tracelake.plans import derive
from tracelake.schemas import LOG_FIELDS, USER_ROW

from conftest import SF_SMALL

E = '{"timestamp":"t","level":"i","component":"c","message":"m"}'

CASES = [
    ("[" + E + "," + E + "]", 2),
    (E, 1),
    (E[:-1] + ',"x":{"y":[1]}}', 1),
    ("[]", 0),
    (E.replace('"i"', '"\U0001F600"'), 1),
    ('{"timestamp":"t","level":"i","component":"c"}', "bad"),
    (E.replace('"m"', "null"), "bad"),
    (E.replace('"t"', "5"), "bad"),
    (E.replace('"i"', '"ii"'), "bad"),
    (E.replace('"level"', '"LEVEL"'), "bad"),
    (E + " zz", "bad"),
    ("[" + E + "] zz", "bad"),
    (E + "} zz", "bad"),
    (E + "," + E, "bad"),
    (E + ',"q":1', "bad"),
    ("[" + E + ',{"timestamp":5}]', "bad"),
    (E[:-1] + ',"level":"w"}', "bad"),
    ("xx", "bad"),
    ("", "bad"),
    ("5", "bad"),
    ('["t","i","c","m"]', 1),
    ('[["t","i","c","m"],' + E + ',["","w","",""]]', 3),
    ('[["t","i","c","m"]]', 1),
    ('["t","i","c"]', "bad"),
    ('["t","i","c","m","x"]', "bad"),
    ('["t","ii","c","m"]', "bad"),
    ('["t","i","c",5]', "bad"),
    ('[["t","i","c","m"],5]', "bad"),
    ('[["t","i","c","m"],["t","i"]]', "bad"),
]


@pytest.fixture(scope="module")
def verdicts(spark):
    rows = [(i, bytearray(v.encode())) for i, (v, _) in enumerate(CASES)] + [(len(CASES), None)]
    df = spark.createDataFrame(rows, "offset long, value binary")
    out = {}
    for r in decode_verdicts(df, lineage=["offset"]).collect():
        out.setdefault(r.offset, []).append(r)
    return out


@pytest.mark.parametrize("i", range(len(CASES)))
def test_strict_verdicts(verdicts, i):
    value, expected = CASES[i]
    got = verdicts.get(i, [])
    if expected == "bad":
        assert len(got) == 1 and got[0].verdict == "bad" and got[0].reason in ("malformed_json", "bad_row")
    else:
        assert len(got) == expected and all(r.verdict == "ok" for r in got)
        assert [r.pos for r in got] == list(range(expected))


def test_tombstone_skipped(verdicts):
    assert len(CASES) not in verdicts


def test_invalid_utf8_is_bad(spark):
    df = spark.createDataFrame([(0, bytearray(b'{"timestamp":"\xff","level":"i","component":"c","message":"m"}'))], "offset long, value binary")
    (r,) = decode_verdicts(df, lineage=["offset"]).collect()
    assert r.verdict == "bad" and r.reason == "invalid_utf8"


def test_fail_mode_raises_and_good_passes(spark):
    good = spark.createDataFrame([(0, bytearray(("[" + E + "," + E + "]").encode()))], "offset long, value binary")
    assert [tuple(r) for r in decode(good, lineage=["offset"]).collect()] == [(0, 0, "t", "i", "c", "m"), (0, 1, "t", "i", "c", "m")]
    bad = spark.createDataFrame([(7, bytearray((E + " zz").encode()))], "offset long, value binary")
    with pytest.raises(Exception, match="bad message at 7: malformed_json"):
        decode(bad, lineage=["offset"]).collect()


def test_users_message_shape(spark):
    users = spark.createDataFrame([(1, "User1"), (2, "User2")], USER_ROW)
    (msg,) = encode(users, ["id", "name"], chunk_by=F.lit(0), order_by=["id"]).collect()
    assert msg.value == '[{"id":1,"name":"User1"},{"id":2,"name":"User2"}]'
    assert msg.n_rows == 2
    back = decode(spark.createDataFrame([(msg.value,)], "value string"), USER_ROW, lineage=[])
    assert [tuple(r) for r in back.select("id", "name").collect()] == [(1, "User1"), (2, "User2")]


def test_users_negative_id_rejected(spark):
    df = spark.createDataFrame([('[{"id":-1,"name":"x"}]',), ('[{"id":1.5,"name":"x"}]',)], "value string")
    assert [r.verdict for r in decode_verdicts(df, USER_ROW, lineage=[]).collect()] == ["bad", "bad"]


def test_encode_escaping_round_trip(spark):
    rows = spark.createDataFrame(
        [("t", "i", "c", 'quote " backslash \\ tab \t ctl \u001f uni é \U0001F600')], ", ".join(f"{f} string" for f in LOG_FIELDS)
    )
    (msg,) = encode(rows, LOG_FIELDS).collect()
    assert json.loads(msg.value)[0]["message"].startswith('quote " backslash')
    back = decode(spark.createDataFrame([(msg.value,)], "value string"), lineage=[]).select(*LOG_FIELDS)
    assert back.collect() == rows.collect()


@pytest.mark.parametrize("chunk_rows", [1, 7, 1000])
def test_parse_encode_decode_round_trip(spark, chunk_rows):
    lines = derive.trace_lines(derive.table(spark, SF_SMALL, "events"))
    parsed = parse_log_lines(lines)
    msgs = encode(parsed, LOG_FIELDS, chunk_rows=chunk_rows)
    sizes = [r.n_rows for r in msgs.select("n_rows").collect()]
    assert max(sizes) <= chunk_rows
    back = decode(as_topic_messages(msgs, "t", 3)).select(*LOG_FIELDS)
    assert Counter(map(tuple, back.collect())) == Counter(map(tuple, parsed.collect()))


def test_positional_order_kept_inside_message(spark):
    df = spark.range(0, 50, numPartitions=3).select(F.col("id").cast("string").alias("timestamp"), F.lit("i").alias("level"),
                                                  F.lit("c").alias("component"), F.lit("m").alias("message"))
    for r in encode(df, LOG_FIELDS, chunk_rows=6).collect():
        ts = [int(x["timestamp"]) for x in json.loads(r.value)]
        assert ts == sorted(ts) and len(ts) <= 6


def test_encode_each_single_objects(spark):
    df = spark.createDataFrame([("t", "i", "c", "m")], ", ".join(f"{f} string" for f in LOG_FIELDS))
    assert encode_each(df).first().value == E


def test_positional_messages_across_arrow_batches_and_groups(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(0, 200, numPartitions=2).select(
            F.col("id").cast("string").alias("timestamp"), F.lit("i").alias("level"), F.lit("c").alias("component"),
            F.lit("m").alias("message"), F.floor(F.col("id") / 23).cast("string").alias("file_path"),
        )
        msgs = encode(df, LOG_FIELDS, chunk_rows=5, group_by=["file_path"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = []
    for m in msgs:
        ids = [int(x["timestamp"]) for x in json.loads(m.value)]
        assert 1 <= len(ids) <= 5 and len(ids) == m.n_rows
        assert ids == list(range(ids[0], ids[0] + len(ids)))  # consecutive, in scan order
        assert {str(i // 23) for i in ids} == {m.file_path}  # never mixes groups
        seen += ids
    assert sorted(seen) == list(range(200))
    assert len({m.chunk for m in msgs}) == len(msgs)


def test_positional_messages_bounded_by_bytes(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        df = spark.range(0, 300, numPartitions=3).select(
            F.col("id").cast("string").alias("timestamp"), F.lit("i").alias("level"), F.lit("c").alias("component"),
            F.repeat(F.lit("é"), (F.col("id") * 7) % 120).alias("message"),
            F.floor(F.col("id") / 40).cast("string").alias("file_path"),
        )
        msgs = encode(df, LOG_FIELDS, chunk_rows=50, max_bytes=600, group_by=["file_path"]).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = []
    for m in msgs:
        body = json.loads(m.value)
        assert len(m.value.encode()) <= 600 or m.n_rows == 1
        assert 1 <= m.n_rows <= 50 and m.n_rows == len(body)
        ids = [int(x["timestamp"]) for x in body]
        assert ids == list(range(ids[0], ids[0] + len(ids)))
        assert {str(i // 40) for i in ids} == {m.file_path}
        seen += ids
    assert sorted(seen) == list(range(300))
    # greedy: a message is only cut early when the next row would not fit (or the group/row limit is hit)
    by_start = {json.loads(m.value)[0]["timestamp"]: m for m in msgs}
    assert len(by_start) == len(msgs)


def test_ordered_positional_messages(spark):
    users = spark.range(0, 5000, numPartitions=5).select(
        ((F.col("id") * 7919) % 5000).alias("id"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("name")
    )
    msgs = sorted(encode(users, ["id", "name"], chunk_rows=300, order_by=["id"]).collect(), key=lambda m: m.chunk)
    ids = [x["id"] for m in msgs for x in json.loads(m.value)]
    assert ids == list(range(5000))  # message ids follow id order, rows inside each message too
    assert max(m.n_rows for m in msgs) <= 300


def test_large_messages_decode(spark):
    many = "[" + ",".join([E] * (17 * 1024 * 1024 // len(E) + 1)) + "]"  # 17 MiB of small rows
    huge = E.replace('"m"', '"' + "x" * (17 * 1024 * 1024) + '"')  # one 17 MiB string
    df = spark.createDataFrame([(0, many), (1, huge)], "offset long, value string")
    got = decode_verdicts(df, lineage=["offset"]).groupBy("offset", "verdict", "reason").count().collect()
    by_offset = {r.offset: (r.verdict, r.reason, r["count"]) for r in got}
    assert by_offset[0] == ("ok", None, many.count("{"))
    assert by_offset[1] == ("ok", None, 1)
