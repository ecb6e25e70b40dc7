"""Table changes, paging, ids."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tracelake.functions.text import unicode_trim
from tracelake.operators.tableops import (
    assign_ids, count_rows, delete, exists, insert, latest_per_key, page, top, update, upsert,
)


@pytest.fixture()
def users(spark):
    return spark.createDataFrame([(1, "User1"), (2, "User2"), (3, None), (4, "  pad  ")], "id long, name string")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, x if x is not None else 0) for x in t))


def test_insert_by_name(spark, users):
    more = spark.createDataFrame([("User5",)], "name string")
    assert (None, "User5") in _rows(insert(users, more))


def test_update_null_condition_is_no_update(spark, users):
    out = update(users, {"name": F.lit("X")}, F.col("name") == "User1")
    assert _rows(out) == [(1, "X"), (2, "User2"), (3, None), (4, "  pad  ")]


def test_update_normalises_only_assigned_column(spark, users):
    out = update(users, {"name": F.concat(F.lit(" "), F.col("name"), F.lit(" "))}, "id = 2", normalise={"name": unicode_trim})
    assert _rows(out)[1] == (2, "User2") and _rows(out)[3] == (4, "  pad  ")


def test_delete_keeps_null_condition_rows_and_counts(spark, users):
    obs = Observation("del")
    out = delete(users, F.col("name").like("User%"), observation=obs)
    assert _rows(out) == [(3, None), (4, "  pad  ")]
    assert obs.get["deleted"] == 2


def test_upsert_latest_change_wins(spark, users):
    changes = spark.createDataFrame(
        [(1, "A", 1), (1, "B", 3), (1, "C", 2), (9, "New", 1)], "id long, name string, version int"
    )
    out = upsert(users, changes, "id", order_by=["version"])
    assert _rows(out) == [(1, "B"), (2, "User2"), (3, None), (4, "  pad  "), (9, "New")]
    assert out.columns == ["id", "name"]


def test_latest_per_key_is_partial_aggregate(spark):
    changes = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(changes, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
    assert sorted(tuple(r) for r in latest_per_key(changes, ["k"], ["v"]).collect()) == [(0, 999), (1, 997), (2, 998)]


def test_assign_ids_fills_only_missing(spark):
    base = spark.createDataFrame([(5, "a"), (None, "b"), (2, "c"), (None, "d"), (None, "e")], "id long, name string")
    out = assign_ids(base.repartition(3))
    ids = sorted(r.id for r in out.collect())
    assert ids == [2, 5, 6, 7, 8]
    assert {r.name: r.id for r in out.collect()}["a"] == 5


def test_assign_ids_many_partitions_dense_unique(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.when(F.col("id") % 4 == 0, F.col("id")).alias("id"), F.col("id").cast("string").alias("name")
    )
    out = assign_ids(df)
    ids = [r.id for r in out.select("id").collect()]
    assert len(ids) == len(set(ids)) == 5000
    assert max(ids) == 4996 + (5000 - 1250)


def test_page_and_top(spark):
    df = spark.range(100).select(F.col("id"), F.col("id").cast("string").alias("name"))
    assert [r.id for r in page(df, ["id"], 10, 10).collect()] == list(range(10, 20))
    assert [r.id for r in top(df, [F.desc("id")], 3).collect()] == [99, 98, 97]
    plan = top(df, ["id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_count_and_exists(spark, users):
    assert count_rows(users).first().n == 4
    assert exists(users, "id = 2") and not exists(users, "id = 99")
