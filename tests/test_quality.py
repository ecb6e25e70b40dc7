"""Validation, change audit, statement log, normalisation."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tracelake.operators.quality import (
    BAD_ID, DUPLICATE_ID, EMPTY_NAME, NAME_TOO_LONG, audit_changes, normalise, op_log_entry, validate,
)


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame(
        [(1, "ok"), (2, ""), (3, None), (4, "x" * 256), (-5, "neg"), (6, "a"), (6, "b")], "id long, name string"
    )


def test_flag_codes(rows):
    got = {(r.id, r.name): r.error_code for r in validate(rows).collect()}
    assert got == {
        (1, "ok"): 0, (2, ""): EMPTY_NAME, (3, None): EMPTY_NAME, (4, "x" * 256): NAME_TOO_LONG,
        (-5, "neg"): BAD_ID, (6, "a"): DUPLICATE_ID, (6, "b"): DUPLICATE_ID,
    }


def test_split(rows):
    good, bad = validate(rows, mode="split")
    assert [r.id for r in good.collect()] == [1]
    assert bad.count() == 6 and "error" in bad.columns


def test_fail_mode(spark, rows):
    with pytest.raises(Exception, match="10001: NAME must not be empty"):
        validate(rows.where("id = 2"), mode="fail").collect()
    assert validate(rows.where("id = 1"), mode="fail").count() == 1


def test_audit_every_updated_row_or_only_changed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, name string")
    new = spark.createDataFrame([(1, "A"), (2, "b"), (3, None)], "id long, name string")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert audit_changes(old, new, changed_at=at).count() == 3
    (r,) = audit_changes(old, new, changed_at=at, only_changed=True).collect()
    assert (r.id, r.old_name, r.new_name, r.changed_at) == (1, "a", "A", dt.datetime(2024, 1, 1))


def test_op_log_row_even_for_zero(spark):
    (r,) = op_log_entry(spark, "DELETE USERS", 0, dt.datetime(2024, 1, 1)).collect()
    assert (r.op, r.n_rows) == ("DELETE USERS", 0)


def test_normalise_unicode_trim(spark):
    df = spark.createDataFrame([("\u00a0 x \u2003",)], "name string")
    assert normalise(df, "name").first().name == "x"


def test_fetch_users_normalises_and_fails_on_bad_id(spark):
    from tracelake.operators.quality import fetch_users

    t = spark.createDataFrame([(" 1 ", " User1 "), ("2", None)], "ID string, NAME string")
    assert [tuple(r) for r in fetch_users(t).collect()] == [(1, "User1"), (2, "")]
    with pytest.raises(Exception, match="bad ID: -3"):
        fetch_users(spark.createDataFrame([("-3", "x")], "ID string, NAME string")).collect()


def test_delete_with_log_writes_statement_row_even_for_zero(spark, tmp_path):
    from tracelake.plans.jobs import delete_with_log

    users = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    assert delete_with_log(spark, users, "id = 1", str(tmp_path / "v2"), str(tmp_path / "oplog")) == 1
    assert delete_with_log(spark, users, "id = 9", str(tmp_path / "v3"), str(tmp_path / "oplog")) == 0
    log = sorted(r.n_rows for r in spark.read.parquet(str(tmp_path / "oplog")).collect())
    assert log == [0, 1]
    assert spark.read.parquet(str(tmp_path / "v2")).count() == 1


def test_role_rules(spark):
    from tracelake.operators.quality import ROLE_MISSING, ROLE_TOO_LONG, ROLE_USER_MISSING, role_rules

    roles = spark.createDataFrame([(1, "admin"), (None, "x"), (2, None), (3, "r" * 51)], "user_id long, role string")
    got = [r.error_code for r in validate(roles, role_rules(), unique_key=None).collect()]
    assert got == [0, ROLE_USER_MISSING, ROLE_MISSING, ROLE_TOO_LONG]


def test_update_with_audit_one_pass(spark):
    from tracelake.operators.quality import update_with_audit

    df = spark.createDataFrame([(1, "a"), (2, "B"), (3, None)], "id long, name string")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    nxt, audit = update_with_audit(df, {"name": F.upper("name")}, "id <= 2", changed_at=at)
    assert sorted(tuple(r) for r in nxt.where("id <= 2").collect()) == [(1, "A"), (2, "B")]
    assert sorted((r.id, r.old_name, r.new_name) for r in audit.collect()) == [(1, "a", "A"), (2, "B", "B")]
    _, changed = update_with_audit(df, {"name": F.upper("name")}, "id <= 2", changed_at=at, only_changed=True)
    assert [(r.id, r.old_name, r.new_name) for r in changed.collect()] == [(1, "a", "A")]
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
