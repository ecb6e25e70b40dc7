"""Stored tables: changes that last, lost jobs, untouched buckets, keys, generated ids, deep pages, views, metadata."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tracelake.operators import ids, stored
from tracelake.operators.sinks import REQUIRED, create_table_as, ensure_table, write_csv
from tracelake.operators.tableops import deep_page
from tracelake.operators.views import create_persistent_user_views, create_sql_view, drop_view
from tracelake.schemas import LOG_ENTRY
from tracelake.sources.catalog import columns_of

USERS = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType(), False), T.StructField("note", T.StringType())])


@pytest.fixture
def users(spark, tmp_path):
    name = f"default.stored_{random.randrange(10**9)}"
    stored.create(spark, name, USERS, "id", buckets=8, location=str(tmp_path / "rows"))
    stored.insert(spark, name, frame(spark, [(i, f"n{i}", None) for i in range(100)]))
    yield name
    stored.drop(spark, name)


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, note string")


def rows_of(spark, name):
    return {r["id"]: (r["name"], r["note"]) for r in spark.table(name).collect()}


def files(spark, name):
    return {r[0] for r in spark.table(f"{name}_rows").select(F.input_file_name()).distinct().collect()}


def test_changes_in_turn_equal_a_dictionary(spark, users):
    plain = {i: (f"n{i}", None) for i in range(100)}
    rng = random.Random(5)
    for step in range(2):
        batch = [(1000 * (step + 1) + i, f"new{i}", "x") for i in range(7)]
        stored.insert(spark, users, frame(spark, batch))
        plain |= {i: (n, x) for i, n, x in batch}
        changes = [(rng.randrange(120), f"c{step}-{i}", None) for i in range(20)]
        latest = {}
        for i, n, x in changes:
            latest[i] = max(latest.get(i, ("", None)), (n, ""))
        ordered = frame(spark, changes).withColumn("at", F.col("name"))
        stored.upsert(spark, users, ordered, order_by=["at"])
        plain |= {i: (n, None) for i, (n, _) in latest.items()}
        stored.update(spark, users, {"note": F.lit(f"u{step}")}, F.col("id") % 10 == step)
        plain = {i: (n, f"u{step}" if i % 10 == step else x) for i, (n, x) in plain.items()}
        stored.delete(spark, users, F.col("id") % 17 == step)
        plain = {i: v for i, v in plain.items() if i % 17 != step}
        assert rows_of(spark, users) == plain
    stored.insert(spark, users, frame(spark, [(7000, "late", None)]))
    plain[7000] = ("late", None)
    assert stored.compact(spark, users) == 1 and rows_of(spark, users) == plain
    assert len(stored.vacuum(spark, users)) > 8 and rows_of(spark, users) == plain
    assert spark.table(users).columns == ["id", "name", "note"]


def test_lost_job_leaves_the_old_rows(spark, users, monkeypatch):
    before = rows_of(spark, users)

    def lost(*a):
        raise RuntimeError("lost driver")

    real = stored._switch
    for change in (lambda: stored.update(spark, users, {"name": F.lit("x")}), lambda: stored.delete(spark, users, "id < 50"),
                   lambda: stored.insert(spark, users, frame(spark, [(500, "a", None)])), lambda: stored.upsert(spark, users, frame(spark, [(1, "a", None)]))):
        monkeypatch.setattr(stored, "_switch", lost)
        with pytest.raises(RuntimeError):
            change()
        assert rows_of(spark, users) == before
        monkeypatch.setattr(stored, "_switch", real)
    stored.delete(spark, users, "id < 50")  # what lost jobs wrote is not taken up
    assert rows_of(spark, users) == {i: v for i, v in before.items() if i >= 50}


def test_an_old_reader_keeps_its_rows(spark, users):
    old = spark.table(users)
    stored.update(spark, users, {"name": F.lit("x")})
    assert {r["name"] for r in old.collect()} == {f"n{i}" for i in range(100)}
    assert {r["name"] for r in spark.table(users).collect()} == {"x"}


def test_only_touched_buckets_are_read_and_written(spark, users):
    state = stored.state_of(spark, users)
    before = files(spark, users)
    one = stored._touched(frame(spark, [(3, "x", None)]), state)
    read = stored.rows_in(spark, users, state, one)
    assert len(one) == 1 and {f"_bucket={one[0]}/" in f for f in read.inputFiles()} == {True}
    assert "PartitionFilters: [" in read._jdf.queryExecution().toString()
    assert stored.upsert(spark, users, frame(spark, [(3, "changed", None)])) == 1
    new = files(spark, users) - before
    assert new and all(f"_bucket={one[0]}/" in f for f in new) and before <= files(spark, users)
    assert rows_of(spark, users)[3] == ("changed", None) and len(rows_of(spark, users)) == 100
    assert stored.delete(spark, users, "id = -1") == 0
    shown = spark.table(users).inputFiles()
    assert not any(f"_bucket={one[0]}/" in f and f in before for f in shown)


def test_keys_are_unique_and_never_null(spark, users):
    before = rows_of(spark, users)
    for bad in ([(5, "a", None), (200, "b", None)], [(300, "a", None), (300, "b", None)]):
        with pytest.raises(stored.KeyExists):
            stored.insert(spark, users, frame(spark, bad))
    with pytest.raises(Exception, match="NULL in required column id"):
        stored.insert(spark, users, frame(spark, [(None, "a", None)]))
    with pytest.raises(Exception, match="NULL in required column name"):
        stored.update(spark, users, {"name": F.lit(None).cast("string")}, "id = 4")
    with pytest.raises(stored.KeyExists):
        stored.upsert(spark, users, frame(spark, [(1, "a", None), (1, "b", None)]))
    with pytest.raises(ValueError):
        stored.update(spark, users, {"id": F.lit(1)})
    assert rows_of(spark, users) == before
    flagged = stored.flag_existing(spark, users, frame(spark, [(1, "a", None), (300, "b", None), (301, "c", None), (301, "d", None)]))
    assert sorted((r["id"], r["error_code"]) for r in flagged.collect()) == [(1, 10004), (300, 0), (301, 10004), (301, 10004)]


@pytest.mark.parametrize("few", [500, 1])
def test_existing_keys_by_name_or_range(spark, users, few, monkeypatch):
    monkeypatch.setattr(stored, "FEW_KEYS", few)
    batch = frame(spark, [(i, "x", None) for i in range(95, 130)])
    assert sorted(r["id"] for r in stored.existing_keys(spark, users, batch).collect()) == list(range(95, 100))


def test_conflict(spark, users):
    state = stored.state_of(spark, users)
    stored.delete(spark, users, "id = 1")
    with pytest.raises(stored.Conflict):
        stored._publish(spark, users, state, state.version + 1, state.current)


def test_interleaved_reservations_give_distinct_ids(spark, users, tmp_path):
    ledger = str(tmp_path / "ids")
    new = spark.createDataFrame([(f"g{i}", None) for i in range(10)], "name string, note string")
    assert ids.insert_generated(spark, users, new, ledger) == (100, 10)
    a = ids.reserve(spark, ledger, 5)
    b = ids.reserve(spark, ledger, 7)  # another writer, before the first one writes
    for first, n, tag in ((b, 7, "b"), (a, 5, "a")):
        stored.insert(spark, users, frame(spark, [(first + i, f"{tag}{i}", None) for i in range(n)]))
    mixed = frame(spark, [(None, "m0", None), (900, "given", None), (None, "m1", None)])
    assert ids.insert_generated(spark, users, mixed, ledger) == (901, 2)
    got = rows_of(spark, users)
    assert len(got) == 100 + 10 + 12 + 3 and {a, b} == {110, 115} and {901, 902, 900} <= set(got)
    assert ids.high_water(spark, ledger) == (4, 903)


def test_reservation_lost_race_and_unfinished(spark, tmp_path, monkeypatch):
    ledger = str(tmp_path / "ids")
    real, seen = ids.high_water, []

    def stale(s, path):
        seen.append(1)
        return (0, None) if len(seen) == 1 else real(s, path)  # the first look is before the other writer's reservation

    assert ids.reserve(spark, ledger, 3) == 0
    monkeypatch.setattr(ids, "high_water", stale)
    assert ids.reserve(spark, ledger, 4) == 3 and len(seen) == 2
    monkeypatch.setattr(ids, "high_water", real)
    (tmp_path / "ids" / f"{2:012d}").write_text("")
    monkeypatch.setattr(ids, "PATIENCE", 0.3)
    with pytest.raises(RuntimeError, match="never finished"):
        ids.reserve(spark, ledger, 1)


@pytest.mark.parametrize("offset", [0, 7, 500, 2990, 3000, 5000])
def test_deep_page(spark, offset):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 100).alias("k"), "id", F.when(F.col("id") % 7 > 0, F.col("id")).alias("n"))
    df = df.repartition(5)
    got = [tuple(r) for r in deep_page(df, [F.col("k").desc(), "id"], 20, offset).collect()]
    rows = sorted((tuple(r) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert got == rows[offset : offset + 20]


def test_deep_page_sorts_only_what_it_needs(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(20_000).select((F.col("id") % 2).alias("k"), F.lit("same").alias("v"))  # two values, all rows equal but for them
        page = deep_page(df, ["k"], 10, 15_000)
        assert [tuple(r) for r in page.collect()] == [(1, "same")] * 10
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters" in plan and "GreaterThanOrEqual(_range" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_persistent_views_follow_their_base(spark, tmp_path):
    create_table_as(spark, "default.pv_u", spark.createDataFrame([(1, " a "), (2, None), (3, " c")], "id long, name string"), location=str(tmp_path / "u"))
    create_table_as(spark, "default.pv_r", spark.createDataFrame([(1, "admin")], "user_id long, role string"), location=str(tmp_path / "r"))
    names = create_persistent_user_views(spark, "default.pv_u", "default.pv_r", prefix="default.pv_")
    other = spark.newSession()  # they belong to the catalog, not to the session
    assert sorted(tuple(r) for r in other.table("default.pv_users_active").collect()) == [(1, "a"), (3, "c")]
    assert other.table("default.pv_users_with_roles").count() == 3
    create_sql_view(spark, "default.pv_users", "SELECT id, 'z' AS name FROM default.pv_u WHERE id > 1", temporary=False)
    assert sorted(tuple(r) for r in other.table("default.pv_users_active").collect()) == [(2, "z"), (3, "z")]
    assert other.table("default.pv_users_count").first()[0] == 2
    for name in reversed(names):
        drop_view(spark, name, temporary=False)
    assert not any(spark.catalog.tableExists(n) for n in names)
    for t in ("default.pv_u", "default.pv_r"):
        spark.sql(f"DROP TABLE {t}")


def test_declared_column_types(spark, tmp_path):
    spark.sql(f"CREATE TABLE default.declared (id BIGINT, name VARCHAR(255), code CHAR(3), amount DECIMAL(12,2), free STRING) USING parquet "
              f"LOCATION '{tmp_path / 't'}' TBLPROPERTIES ('{REQUIRED}' = 'id,name')")  # fmt: skip
    got = [tuple(r) for r in columns_of(spark, "default.declared").collect()]
    assert got == [
        ("id", "BIGINT", None, None, 1, False), ("name", "VARCHAR(255)", 255, None, 2, False), ("code", "CHAR(3)", 3, None, 3, True),
        ("amount", "DECIMAL(12,2)", 12, 2, 4, True), ("free", "STRING", None, None, 5, True),
    ]
    ensure_table(spark, "default.declared_log", LOG_ENTRY, location=str(tmp_path / "l"))
    assert not any(r.is_nullable for r in columns_of(spark, "default.declared_log").collect())
    for t in ("declared", "declared_log"):
        spark.sql(f"DROP TABLE default.{t}")


def test_ordered_export_is_sorted_in_file_order(spark, tmp_path):
    rng = random.Random(1)
    ids_ = rng.sample(range(10_000), 3000)
    df = spark.createDataFrame([(i, f"n{i}") for i in ids_], "id long, name string").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_csv(df, str(tmp_path / "csv"), header=False, order_by=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(p for p in (tmp_path / "csv").iterdir() if p.name.startswith("part-"))
    lines = [int(line.split(",")[0]) for p in parts for line in p.read_text().splitlines()]
    assert len(parts) > 1 and lines == sorted(ids_)
